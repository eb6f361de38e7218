"""JSON text columns: a dictionary of the paths and kinds in them, and typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneldeck.session import write_stage

NESTED = ("object", "array")
# Heads of Spark's type names -> kinds.
KINDS = {"VOID": "null", "OBJECT": "object", "ARRAY": "array", "BOOLEAN": "boolean", "STRING": "string",
         "BIGINT": "integer", "INT": "integer", "SMALLINT": "integer", "TINYINT": "integer",
         "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number"}


def kind_of(value: Column) -> Column:
    """null, boolean, integer, number, string, object, array or other, of a variant."""
    head = F.regexp_extract(F.schema_of_variant(value), "^(" + "|".join(KINDS) + ")", 1)
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    return F.coalesce(F.try_element_at(kinds, head), F.lit("other"))


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with only these columns, each value computed once however often
    later steps name it: as elements of an array they are not inlined there."""
    made = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return rows.select(F.explode(made).alias("_made")).select("_made.*")


def path_table(rows: DataFrame, json_col: str) -> DataFrame:
    """path, kind, n: how many values of each kind stand at each path of a JSON column.

    ``$`` is the whole text: of kind ``missing`` where the column is null and ``bad``
    where it does not parse (cut off, empty, or a key given twice).  ``[*]`` stands for
    all elements of an array; a key that is no plain name is quoted, as in ``$['a b']``.
    Every level of nesting is one pass over the column, combined on the map side and
    shuffled as counts; the driver only learns whether a level holds nested values.
    An empty table gives no rows.
    """
    spark = rows.sparkSession
    parsed = once(rows, given=F.col(json_col).isNotNull(), value=F.try_parse_json(F.col(json_col)))
    level = once(parsed, path=F.lit("$"), value=F.col("value"), kind=F.when(~F.col("given"), "missing").when(
        F.col("value").isNull(), "bad").otherwise(kind_of(F.col("value"))))
    found = None
    while True:
        counts = write_stage(level.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")), "json-paths")
        found = counts if found is None else found.unionByName(counts)
        if counts.where(F.col("kind").isin(*NESTED)).isEmpty():
            return found
        parents = level.where(F.col("kind").isin(*NESTED)).select(
            F.col("path").alias("above"), F.col("kind").alias("held"), F.col("value").alias("whole"))
        key = F.when(F.col("key").rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), "key")).otherwise(
            F.concat(F.lit("['"), "key", F.lit("']")))
        held = parents.lateralJoin(spark.tvf.variant_explode(F.col("whole").outer()))
        level = once(held, path=F.concat("above", F.when(F.col("held") == "array", "[*]").otherwise(key)),
                     value=F.col("value"), kind=kind_of(F.col("value")))


def shred(rows: DataFrame, json_col: str, fields: dict[str, tuple[str, str]], state: str = "json_state",
          misfits: str = "misfits") -> DataFrame:
    """``rows`` with a typed column for each name -> (path, type), in one pass without
    a shuffle.  ``state`` is ok, bad (does not parse) or missing (null); ``misfits``
    counts the fields that hold a value which is not of their type.  Such a field, an
    absent path and a JSON null are null.  A name that ``rows`` already has is an error.
    """
    clash = {c.lower() for c in rows.columns} & {c.lower() for c in (*fields, state, misfits)}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    doc = F.try_parse_json(F.col(json_col))
    typed = {name: F.try_variant_get(doc, path, kind) for name, (path, kind) in fields.items()}
    held = {name: F.try_variant_get(doc, path, "variant") for name, (path, _) in fields.items()}
    off = [(held[c].isNotNull() & ~F.is_variant_null(held[c]) & typed[c].isNull()).cast("int") for c in fields]
    return rows.select("*", *[v.alias(c) for c, v in typed.items()],
                       F.when(F.col(json_col).isNull(), "missing").when(doc.isNull(), "bad").otherwise("ok").alias(state),
                       sum(off, F.lit(0)).alias(misfits))
