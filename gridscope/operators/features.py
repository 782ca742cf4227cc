"""Key-value feature lines as one wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Feature names in table order.
FEATURES = (
    "uid", "age", "gender", "marriagestatus", "education", "consumptionability", "lbs",
    "interest1", "interest2", "interest3", "interest4", "interest5",
    "kw1", "kw2", "kw3", "topic1", "topic2", "topic3",
    "appidinstall", "ct", "os", "carrier", "house",
)
LIST_PREFIXES = ("interest", "kw", "topic")
# Numbered columns of a list feature in the wide table; longer lists go on in a column of the rest.
LIST_SLOTS = 20
ABSENT = "0"


def is_list(name: str) -> bool:
    return name.startswith(LIST_PREFIXES)


def feature_maps(lines: DataFrame) -> DataFrame:
    """Per line (column ``value``) a map from feature name (lower case) to its values as text.

    The first of equal names counts. Step by step, so that no step is computed per item again.
    """
    items = F.filter(F.split("value", r"\|"), lambda item: item.contains(" "))
    names = F.transform("_items", lambda item: F.lower(F.substring_index(item, " ", 1)))
    values = F.transform("_items", lambda item: F.substring(item, F.instr(item, " ") + 1, F.length(item)))
    pairs = F.filter(
        F.arrays_zip(F.col("_names").alias("name"), F.col("_values").alias("value")),
        lambda pair, at: F.array_position("_names", pair["name"]) == at + 1,
    )
    return (
        lines.select(items.alias("_items"))
        .select(names.alias("_names"), values.alias("_values"))
        .select(F.map_from_entries(pairs).alias("features"))
    )


def feature_values(lines: DataFrame) -> DataFrame:
    """C15, long form: every value of every feature, (uid, feature, item, position, value); nothing is left out.

    ``item`` counts the items of a line, ``position`` the values of an item, both from 1.
    """
    items = F.filter(F.split("value", r"\|"), lambda item: item.contains(" "))
    with_uid = lines.select("value", items.alias("_items")) \
        .withColumn("uid", F.get(F.split(F.get(F.filter("_items", lambda i: F.lower(i).startswith("uid ")), F.lit(0)), " "), F.lit(1)))
    spread = with_uid.select("uid", F.posexplode("_items").alias("_at", "_item"))
    text = F.rtrim(F.substring("_item", F.instr("_item", " ") + 1, F.length("_item")))
    return spread.select("uid", F.lower(F.substring_index("_item", " ", 1)).alias("feature"), (F.col("_at") + 1).alias("item"),
                         F.posexplode(F.split(text, " ")).alias("_place", "value")) \
        .select("uid", "feature", "item", (F.col("_place") + 1).alias("position"), "value")


def parse_features(lines: DataFrame) -> DataFrame:
    """One column per feature; list features are arrays, the others keep their first value."""
    columns = []
    for name in FEATURES:
        text = F.try_element_at("features", F.lit(name))
        if is_list(name):
            value = F.coalesce(F.split(F.rtrim(text), " "), F.array(F.lit(ABSENT)))
        else:
            value = F.coalesce(F.substring_index(text, " ", 1), F.lit(ABSENT))
        columns.append(value.alias(name))
    return feature_maps(lines).select(*columns)


def widen_features(features: DataFrame, slots: int = LIST_SLOTS) -> DataFrame:
    """List features spread over ``slots`` numbered columns, null beyond the end of the list, and the rest as an array."""
    columns = []
    for name in FEATURES:
        if is_list(name):
            columns += [F.get(F.col(name), F.lit(i)).alias(f"{name}_{i + 1}") for i in range(slots)]
            columns.append(F.slice(name, slots + 1, F.greatest(F.size(name), F.lit(1))).alias(f"{name}_rest"))
        else:
            columns.append(F.col(name))
    return features.select(*columns)


def user_features_wide(lines: DataFrame, slots: int = LIST_SLOTS) -> DataFrame:
    """Text lines (column ``value``) to the wide feature table."""
    return widen_features(parse_features(lines), slots)
