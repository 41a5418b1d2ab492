"""Words of a text as columns, shared by the operators that stay in built-in functions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# white space of the word pattern [^\x20\x09-\x0D]+
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Array of the words of a text; empty for NULL and for white space alone."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.split(bare, BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def packed(df: DataFrame, *needed: str) -> DataFrame:
    """The whole row as `_row` and the needed columns beside it, so that no other name can clash.

    A needed column that the table lacks is NULL.
    """
    have = set(df.columns)
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        *[(F.col(c) if c in have else F.lit(None).cast("string")).alias(f"_{c}") for c in needed],
    )


def unpacked(df: DataFrame, columns) -> DataFrame:
    """The rows that were packed, with their own columns only."""
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def text_key(column: Column) -> Column:
    """A join key that keeps NULL apart from every string."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))
