from pyspark.sql import functions as F

from gridscope.functions import text


def cases():
    null = F.lit(None).cast("string")
    return [
        (text.is_empty(F.lit("")), True), (text.is_empty(null), True), (text.is_empty(F.lit(" ")), False),
        (text.join_items(F.array(F.lit("a"), F.lit("  "), F.lit("b")), "-"), "a-b"),
        (text.equals_any(F.lit(" b "), F.lit("a, b ,c")), True), (text.equals_any(F.lit("d"), F.lit("a,b")), False),
        (text.equals_any(null, F.lit("a")), False), (text.equals_any(F.lit("b"), F.lit("a;b"), ";"), True),
        (text.omit_after(F.lit("abcdef"), 3), "abc..."), (text.omit_after(F.lit("abc"), 3), "abc"),
        (text.cut_with_symbol(F.lit("abcdef"), 3, "#"), "abc#"), (text.cut_with_symbol(F.lit("abc"), 3, "#"), ""),
        (text.mask_email(F.lit("a@b@c.d")), "***@c.d"), (text.mask_email(F.lit("@c.d")), "@c.d"),
        (text.mask_email(F.lit("plain")), "plain"),
        (text.repeat(F.lit("ab"), 3), "ababab"),
        (text.drop_left(F.lit("abcd"), 1), "bcd"), (text.drop_left(F.lit("a"), 2), ""), (text.drop_left(null, 2), ""),
        (text.drop_right(F.lit("abcd"), 1), "abc"), (text.drop_right(F.lit("ab"), 2), "ab"),
        (text.split_items(F.lit("a1b22c"), "[0-9]+"), ["a", "b", "c"]),
        (text.format_by_pattern(F.lit(0.5), "#.00"), ".50"), (text.format_by_pattern(F.lit(12.0), "#.#"), "12"),
        (text.left(F.lit("abc"), 5), "abc"), (text.left(null, 2), ""), (text.right(F.lit("abc"), 2), "bc"),
        (text.strip_whitespace(F.lit(" a\tb\r\nc ")), "abc"),
        (text.strip_punctuation(F.lit("a,b.c！$d+")), "abcd"), (text.strip_punctuation(null), ""),
        (text.count_of(F.lit("aaaa"), "aa"), 2), (text.count_of(null, "a"), 0), (text.count_of(F.lit("a"), ""), 0),
        (text.replace_first(F.lit("abab"), "ab", "X"), "Xab"), (text.replace_first(F.lit("x"), "ab", "X"), "x"),
        (text.replace_last(F.lit("abab"), "ab", "X"), "abX"), (text.replace_last(F.lit("abaab"), "aab", "X"), "abX"),
        (text.remove_all(F.lit("abcab"), "ab"), "c"), (text.remove_all(F.lit("abc"), ""), "abc"),
        (text.upper_first(F.lit("abc")), "Abc"), (text.upper_first(F.lit("éa")), "éa"), (text.upper_first(null), ""),
        (text.lower_first(F.lit("ABC")), "aBC"), (text.lower_first(F.lit("1A")), "1A"),
        (text.left_equal(F.lit("abx"), F.lit("aby"), 2), True), (text.right_equal(F.lit("xab"), F.lit("yac"), 2), False),
    ]


def test_text_functions(spark):
    columns, expected = zip(*cases())
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    wrong = {i: (got, want) for i, (got, want) in enumerate(zip(row, expected)) if got != want}
    assert not wrong
