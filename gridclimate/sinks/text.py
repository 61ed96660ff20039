"""Text renderings of results: a view of texts, comma-separated files and JSON documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ..functions.text import as_text
from ..schemas import SUMMARY


def _texts(value: Column, data_type: DataType) -> Column:
    """A value with all its leaves as text; lists of plain values are one text."""
    if isinstance(data_type, StructType):
        parts = [_texts(value[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        # a struct of NULLs is still a struct, so NULL itself has to be kept apart
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(data_type, ArrayType) and isinstance(data_type.elementType, StructType):
        return F.transform(value, lambda item: _texts(item, data_type.elementType))
    return as_text(value, data_type)


def text_values(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[_texts(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema.fields]
    )


def summary_text(summary: DataFrame) -> DataFrame:
    """The summary with all eight columns as text."""
    return text_values(summary.select(*SUMMARY.fieldNames()))


def register_summary_view(summary: DataFrame, name: str = "summary_text") -> DataFrame:
    """Make the summary a table for SQL, all columns as text."""
    view = summary_text(summary)
    view.createOrReplaceTempView(name)
    return view


def export_csv(rows: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    """Write comma-separated text; lists are joined with a semicolon."""
    text_values(rows).write.mode(mode).option("header", header).csv(path)


def to_json_documents(rows: DataFrame) -> DataFrame:
    """One JSON document per row, in column ``json``: fields in order, all values as text."""
    texts = text_values(rows)
    document = F.to_json(F.struct(*texts.columns), {"ignoreNullFields": "false"})
    return texts.select(document.alias("json"))


def write_document(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store the lines of ``area_document``; the files, in order of their names, are the document."""
    lines.orderBy("part", "key").select("json").write.mode(mode).text(path)


