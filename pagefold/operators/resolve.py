"""Resolution of glyphs (or any keys) to text: sources by priority, composites, substitution rules, siblings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.functions.text import unless_mirrored


def cascade(sources: list[tuple[str, DataFrame]], key: list[str], value: str = "chars") -> DataFrame:
    """key, value, source: of each key the value of the first source that has one that is not empty.

    All sources go through one aggregation. Several values of a source for a key are settled by the least one.
    """
    rows = None
    for priority, (name, df) in enumerate(sources):
        part = df.select(*key, F.nullif(F.col(value), F.lit("")).alias(value), F.lit(priority).alias("priority"), F.lit(name).alias("source")).filter(F.col(value).isNotNull())
        rows = part if rows is None else rows.unionByName(part)
    best = F.min(F.struct("priority", value, "source"))
    return rows.groupBy(*key).agg(best.alias("b")).select(*key, F.col(f"b.{value}").alias(value), F.col("b.source").alias("source"))


def source_counts(wanted: DataFrame, resolved: DataFrame, key: list[str]) -> DataFrame:
    """source, n: how many of the wanted keys each source resolved, `unresolved` for the rest."""
    joined = wanted.select(*key).distinct().join(resolved.select(*key, "source"), key, "left")
    return joined.groupBy(F.coalesce("source", F.lit("unresolved")).alias("source")).agg(F.count(F.lit(1)).alias("n"))


def with_override(base: DataFrame, override: DataFrame, key: list[str], value: str = "chars") -> DataFrame:
    """Both tables; where both have a key, the override's value."""
    o = override.select(*key, F.col(value).alias("__new"))
    return base.select(*key, F.col(value)).join(o, key, "full").select(*key, F.coalesce("__new", value).alias(value))


def same_outline(left: DataFrame, right: DataFrame, points: str, left_key: str, right_key: str, value: str = "chars") -> DataFrame:
    """left_key, value: of the right's keys with the same outline the first in order that has a value.

    Outlines meet by a digest of all their points; empty ones meet nothing.
    """
    sign = lambda df: df.filter(F.size(points) > 0).withColumn("__sign", F.sha2(F.to_json(points), 256))
    r = sign(right).filter(F.nullif(F.col(value), F.lit("")).isNotNull()).groupBy("__sign").agg(F.min_by(value, right_key).alias(value))
    return sign(left).select(left_key, "__sign").join(r, "__sign").select(left_key, value)


def inherit_from_siblings(glyphs: DataFrame, points: str, key: str, value: str = "chars") -> DataFrame:
    """Glyphs without a value get that of the first sibling of the same outline."""
    known, open_ = glyphs.filter(F.col(value).isNotNull()), glyphs.filter(F.col(value).isNull())
    found = same_outline(open_, known, points, key, key, value).withColumnRenamed(value, "__found")
    return glyphs.join(found, key, "left").withColumn(value, F.coalesce(value, "__found")).drop("__found")


def composites(parts: DataFrame, base: DataFrame, key: str = "gid", component: str = "component", order: str = "ord", value: str = "chars", deepest: int = 6) -> DataFrame:
    """key, value of composites: their components' values in order, themselves resolved first; none where a component
    has none, in cycles, or more than `deepest` levels down."""
    known = base.select(key, value)
    for _ in range(deepest):
        joined = parts.join(known.select(F.col(key).alias(component), F.col(value).alias("__v")), component, "left")
        whole = joined.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "__v"))), lambda s: s["__v"]), "").alias(value), F.every(F.col("__v").isNotNull()).alias("__all"))
        known = base.select(key, value).unionByName(whole.filter("__all").select(key, value).join(base.select(key), key, "left_anti"))
    return known.join(parts.select(key).distinct(), key, "left_semi")


def substitution_closure(base: DataFrame, single: DataFrame, ligature: DataFrame, most_rounds: int = 12, save=None) -> DataFrame:
    """gid, chars: candidates of glyphs, closed under substitution rules.

    single (out, inp): out has every candidate of inp. ligature (out, ord, comp): out has the concatenated best (shortest,
    then least) candidates of its components, if all have one. Rounds go on until no candidate is new. save, if given, cuts
    the lineage of a round (a checkpoint or a written table).
    """
    save = save or (lambda df: df.checkpoint())
    known = save(base.select("gid", "chars").filter("chars <> ''").distinct())
    n = known.count()
    for _ in range(most_rounds):
        best = known.groupBy("gid").agg(F.min_by("chars", F.struct(F.length("chars"), "chars")).alias("best"))
        one = single.join(known, single["inp"] == known["gid"]).select(F.col("out").alias("gid"), "chars")
        parts = ligature.join(best, ligature["comp"] == best["gid"], "left")
        whole = parts.groupBy("out").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "best"))), lambda s: s["best"]), "").alias("chars"), F.every(F.col("best").isNotNull()).alias("ok")).filter("ok")
        known = save(known.unionByName(one).unionByName(whole.select(F.col("out").alias("gid"), "chars")).distinct())
        now = known.count()
        if now == n:
            break
        n = now
    return known


def name_parts(names: DataFrame, table: DataFrame, tag: str, key: str = "gid", name: str = "name") -> DataFrame:
    """Text of compound names: their parts' texts in order, feature tags left out; none where another part has no text.

    table: part, chars."""
    parts = names.select(key, F.posexplode(F.split(name, "_")).alias("ord", "part")).filter(~F.col("part").rlike(tag))
    joined = parts.join(table, "part", "left")
    whole = joined.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "chars"))), lambda s: s["chars"]), "").alias("chars"), F.every(F.col("chars").isNotNull()).alias("ok"))
    return whole.filter("ok").select(key, unless_mirrored(F.col("chars")).alias("chars"))


def first_font(fonts: DataFrame) -> DataFrame:
    """ref, xref: of each resource name the font of the first page that has it. Key by page too where names are reused."""
    return fonts.groupBy("ref").agg(F.min_by(F.struct("xref", "name"), F.struct("page", "xref")).alias("f")).select("ref", "f.xref", "f.name")


def family(name: Column, rules: list[tuple[str, str]], other: Column | None = None) -> Column:
    """The family of the first rule whose part the lower-case name holds."""
    n = F.lower(name)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for part, value in rules:
        out = out.when(F.contains(n, F.lit(part)), value)
    return out if other is None else out.otherwise(other)
