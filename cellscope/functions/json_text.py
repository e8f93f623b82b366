"""JSON text columns: the keys they hold with the narrowest types, typed columns, figures by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole-number types, narrowest first, with the bits of their values.
WHOLE = (("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64))
#: Most columns that a projection makes; keys beyond them go to a map column, none is lost.
MOST_COLUMNS = 500


def json_entries(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., key, kind, text): one row for each key of each object in ``column``.

    ``kind``: ``whole``, ``number``, ``bool``, ``text``, ``object``, ``array`` or
    ``null`` (a JSON null). ``text``: the value as text; objects and arrays as
    JSON. Nulls, texts that are not JSON (an object that repeats a key is not)
    and JSON that is no object have no rows. Whole numbers beyond 64 bits are ``number``.
    """
    kept = [F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)]
    parsed = df.select(*kept, F.try_parse_json(F.col(f"`{column}`")).alias("parsed")).where(F.schema_of_variant("parsed").startswith("OBJECT"))
    entries = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("parsed").outer()))
    schema = F.schema_of_variant("value")
    kind = (F.when(F.is_variant_null("value"), "null").when(schema == "BIGINT", "whole").when(schema == "BOOLEAN", "bool").when(schema == "STRING", "text")
            .when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array").otherwise("number"))
    text = F.when(F.is_variant_null("value"), F.lit(None)).otherwise(F.col("value").cast("string"))
    return entries.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "key", kind.alias("kind"), text.alias("text"))


def json_keys(df: DataFrame, column: str) -> DataFrame:
    """(key, n, n_null, type, n_whole, n_number, n_bool, n_text, n_nested): each key and the narrowest type that holds all its values.

    ``n``: objects that have the key; ``n_null``: those with a JSON null.
    ``type``: the narrowest of tinyint to bigint for whole numbers, double
    with others among them, boolean, and string for anything else (texts,
    mixed kinds, objects and arrays as JSON); void if all are null. An empty
    table, or one without an object, gives no rows.

    One pass and one shuffle: values are counted by key in each task first, so
    a key that all rows have costs one row a task.
    """
    whole = F.when(F.col("kind") == "whole", F.col("text").cast("bigint"))
    found = json_entries(df, column).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("null", "whole", "number", "bool", "text")],
        F.count_if(F.col("kind").isin("object", "array")).alias("n_nested"), F.min(whole).alias("least"), F.max(whole).alias("most"))
    some = F.col("n") - F.col("n_null")
    kind = F.when(some == 0, "void")
    for name, bits in WHOLE:
        kind = kind.when((F.col("n_whole") == some) & (F.col("least") >= -(1 << bits - 1)) & (F.col("most") < 1 << bits - 1 if bits < 64 else F.lit(True)), name)
    kind = kind.when(F.col("n_whole") + F.col("n_number") == some, "double").when(F.col("n_bool") == some, "boolean").otherwise("string")
    return found.select("key", "n", "n_null", kind.alias("type"), "n_whole", "n_number", "n_bool", "n_text", "n_nested")


def typed_json(df: DataFrame, column: str, keys: DataFrame | None = None, prefix: str = "", most_columns: int = MOST_COLUMNS,
               rest: str = "rest") -> DataFrame:
    """``df`` with a typed column ``<prefix><key>`` for each key of the JSON objects in ``column``.

    ``keys``: as ``json_keys`` gives (fitted on ``df`` if None: one job). The
    commonest ``most_columns`` keys become columns, in name order; where there
    are more, the others go to the map column ``rest`` (key to text). A key
    that a row does not have, a JSON null, and a text that is not a JSON object
    give null. A value that does not fit its column (of rows that ``keys``
    did not see) gives null. Keys are told apart by case; a column name that
    ``df`` has in any case, or that comes twice, gets ``_`` appended.

    The rows are parsed in one projection, without a shuffle.
    """
    if most_columns < 1:
        raise ValueError("most_columns must be positive")
    keys = json_keys(df, column) if keys is None else keys
    chosen = keys.orderBy(F.desc("n"), "key").select("key", "type").limit(most_columns + 1).collect()  # bounded by the parameter
    more, chosen = len(chosen) > most_columns, sorted(chosen[:most_columns], key=lambda r: r["key"])
    text = F.col(f"`{column}`")
    source = F.when(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), text)
    taken = {c.lower() for c in df.columns}

    def fresh(name: str) -> str:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        return name
    parsed = fresh("parsed_json")
    # Texts first, each cast by itself: one odd value nulls its own column only.
    out = df.withColumn(parsed, F.from_json(source, "map<string,string>"))
    value = lambda k: F.try_element_at(F.col(parsed), F.lit(k))
    cols = {fresh(prefix + r["key"]): value(r["key"]).try_cast("string" if r["type"] == "void" else r["type"]) for r in chosen}
    if more:
        names = F.array(*[F.lit(r["key"]) for r in chosen])
        cols[fresh(rest)] = F.map_filter(F.col(parsed), lambda k, _: ~F.array_contains(names, k))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(n) for n, c in cols.items()])


def json_figures(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., key, n, n_number, total, mean, least, most): figures of each key's numbers, by group.

    ``n``: objects that have the key; the figures are over its numbers (whole
    or not) as doubles, null where it has none. Counted in each task first.
    """
    taken = {"key", "kind", "text", "n", "n_number", "total", "mean", "least", "most"} & {c.lower() for c in by}
    if taken:
        raise ValueError(f"groups with names of the result: {sorted(taken)}")
    x = F.when(F.col("kind").isin("whole", "number"), F.col("text").try_cast("double"))
    groups = [F.col(f"`{c}`") for c in (*by, "key")]
    return json_entries(df, column, by).groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.count(x).alias("n_number"), F.sum(x).alias("total"),
                                                             F.avg(x).alias("mean"), F.min(x).alias("least"), F.max(x).alias("most"))
