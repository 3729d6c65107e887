"""Reading untrusted JSON: check the type first, never coerce.

``with_fields`` takes the members of an object apart once, into a variant column and its type name per member; the
other functions work on those columns, so a document is neither parsed nor searched twice.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_document(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the parsed JSON text as a variant; NULL unless the whole text is one JSON document.

    The parser ignores what follows a complete value. So the text is put into an array in front of a hash of itself.
    Text that is not exactly one value breaks the array, ends it before the hash, or changes its length.
    """
    mark = F.hex(F.xxhash64(F.col(text)))
    wrapped = F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(',"'), F.col("_mark"), F.lit('"]')))
    marked = df.withColumn("_mark", mark).withColumn("_wrapped", wrapped)
    marked = marked.withColumn("_parts", F.try_variant_get(F.col("_wrapped"), "$", "array<variant>"))
    last = F.try_variant_get(F.get("_parts", F.lit(1)), "$", "string")
    doc = F.when((F.size("_parts") == 2) & (last == F.col("_mark")), F.get("_parts", F.lit(0)))
    return marked.withColumn(out, doc).drop("_mark", "_wrapped", "_parts")


def with_fields(df: DataFrame, doc: str, names: Sequence[str]) -> DataFrame:
    """Adds ``_<name>`` (variant, NULL when absent) and ``_<name>_kind`` for every member."""
    fields = {f"_{n}": F.try_variant_get(F.col(doc), f"$.{n}", "variant") for n in names}
    kinds = {f"_{n}_kind": F.schema_of_variant(F.col(f"_{n}")) for n in names}
    return df.withColumns(fields).withColumns(kinds)


def field_columns(names: Sequence[str]) -> list[str]:
    return [c for n in names for c in (f"_{n}", f"_{n}_kind")]


def string_field(name: str) -> Column:
    """The text when the member is a JSON string, else NULL."""
    return F.when(F.col(f"_{name}_kind") == "STRING", F.try_variant_get(F.col(f"_{name}"), "$", "string"))


def number_field(name: str) -> Column:
    """The double when the member is a JSON number, else NULL."""
    kind = F.col(f"_{name}_kind")
    numeric = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
    return F.when(numeric, F.try_variant_get(F.col(f"_{name}"), "$", "double"))


def field_text(name: str) -> Column:
    """The member as JSON text for messages: ``undefined`` when absent, whole doubles without a fraction."""
    v, kind = F.col(f"_{name}"), F.col(f"_{name}_kind")
    number = F.try_variant_get(v, "$", "double")
    double_text = (
        F.when(F.isnan(number) | (F.abs(number) == float("inf")), F.lit("null"))
        .when((F.abs(number) < 1e21) & (number == F.floor(number)), number.try_cast("decimal(22,0)").cast("string"))
        .otherwise(F.to_json(v))
    )
    return F.when(kind.isNull(), F.lit("undefined")).when(kind == "DOUBLE", double_text).otherwise(F.to_json(v))


def is_object(variant: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.col(variant)).startswith("OBJECT"), F.lit(False))
