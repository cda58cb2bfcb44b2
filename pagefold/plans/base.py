"""What the queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Latin letters with accents: the driver tables hold no Arabic.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: White space in DuckDB's expressions, as Java's Unicode class has it.
SPACE = r"[\s\p{Z}\x{85}\x0b]"
DUCK_LINES = "(select doc_id, unnest(l) as line, cast(generate_subscripts(l, 1) - 1 as integer) as line_no from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents))"
DUCK_PLAIN = f"trim(regexp_replace(regexp_replace(lower({{0}}), '[^a-zà-öø-ÿ ]', ' ', 'g'), ' +', ' ', 'g'))"


#: Accented letters and their plain forms: DuckDB's edit distance counts bytes.
FOLD = ("àâäáãåçéèêëíîïìñóôöòõúûüùÿýßæøðþ", "aaaaaaceeeeiiiinooooouuuuyysaodt")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))


def plain(c):
    """Lower-case Latin letters and single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-zà-öø-ÿ ]", " "), " +", " "))
