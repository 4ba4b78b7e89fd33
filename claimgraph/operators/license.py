"""License normalisation from layered evidence, and the labels derived from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import first_match

#: Fixed layer order: the first layer that says something about a dimension wins.
LAYERS = ("url", "terms", "embedded", "manual")
DIMENSIONS = ("use_scope", "commercial_scope", "redistribute_original", "modify", "corporate_use")


def statements(texts: DataFrame, entity: str, layer: str, c: str, mapping: DataFrame) -> DataFrame:
    """(entity, layer, dimension, value) that a mapping (layer, pattern, dimension, value) finds in the texts of one layer.

    Distinct texts meet patterns on the first characters of these, as many as the shortest pattern has, and the longest
    pattern that a text holds wins in each dimension; rule tables may have any size. Empty patterns match nothing.
    """
    rules = mapping.filter((F.col("layer") == layer) & (F.length("pattern") > 0)).select("pattern", "dimension", "value")
    size = rules.agg(F.min(F.length("pattern"))).first()[0] or 1
    rows = texts.select(entity, F.lower(F.col(c)).alias("t")).filter("t is not null")
    pieces = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("t") - (size - 1)), lambda i: F.substring("t", i, F.lit(size))))
    own = rows.select("t").distinct().filter(F.length("t") >= size).select("t", F.explode(pieces).alias("g"))
    hits = own.join(rules.withColumn("g", F.substring("pattern", 1, size)), "g").filter(F.contains("t", "pattern"))
    best = hits.groupBy("t", "dimension").agg(F.max_by("value", F.struct(F.length("pattern"), "pattern", "value")).alias("value"))
    return rows.join(best, "t").select(entity, F.lit(layer).alias("layer"), "dimension", "value")


def code_statements(texts: DataFrame, entity: str, c: str, codes: DataFrame) -> DataFrame:
    """(entity, code, dimension, value, reasons) of license texts that begin with a known code.

    ``codes`` is (code, dimension, value, reasons). Case and underscores do not count. A text is its code, or starts with
    it before a space or bracket; every such beginning is a key, and the longest known one wins, by an equi-join.
    """
    fold = lambda x: F.upper(F.translate(F.trim(x), "_", "-"))
    rows = texts.select(entity, fold(F.col(c)).alias("t")).filter("t <> ''")
    ends = F.filter(F.sequence(F.lit(1), F.length("t")), lambda i: (i == F.length("t")) | F.substring("t", i + 1, F.lit(1)).isin(" ", "("))
    heads = rows.select("t").distinct().select("t", F.explode(F.transform(ends, lambda i: F.substring("t", F.lit(1), i))).alias("code"))
    known = codes.withColumn("code", fold(F.col("code")))
    longest = heads.join(known.select("code").distinct(), "code").groupBy("t").agg(F.max_by("code", F.length("code")).alias("code"))
    return rows.join(longest, "t").join(known, "code").select(entity, "code", "dimension", "value", "reasons")


def layered_license(found: DataFrame, entity: str, dimensions: Sequence[str] = DIMENSIONS) -> tuple[DataFrame, DataFrame]:
    """One row an entity of its license layers in order, and the conflicts in detail.

    ``found`` is (entity, layer, part, seq, dimension, value, reasons): layers are in the fixed order, those of one name by
    ``part`` (the i-th embedded document), and within a layer a later ``seq`` overwrites an earlier one. The first layer
    that knows a dimension gives it. Reasons stand once each, in the order in which they are first seen, then
    ``LICENSE_CONFLICT`` if a later layer disagrees. Conflicts are rows (entity, place, detail) in the order of layers, so
    that an entity with very many documents never is one row of them.
    """
    layer = first_match([(F.col("layer") == n, i) for i, n in enumerate(LAYERS)], len(LAYERS))
    part = F.coalesce("part", F.lit(0))
    source = F.when(F.col("layer") == "embedded", F.concat(F.lit("embedded["), part.cast("string"), F.lit("]"))).otherwise(F.col("layer"))
    rows = found.withColumn("at", F.struct(layer.alias("layer"), part.alias("part"))).withColumn("source", source)
    said = rows.filter("value is not null").groupBy(entity, "at", "source", "dimension").agg(F.max_by("value", "seq").alias("value"))
    won = said.groupBy(entity, "dimension").agg(F.min_by(F.struct("value", "source"), "at").alias("won"))
    order = first_match([(F.col("dimension") == d, i) for i, d in enumerate(dimensions)], len(dimensions))
    detail = F.concat(F.lit("LICENSE_CONFLICT:"), "dimension", F.lit("="), "won.value", F.lit("("), "won.source", F.lit(")_vs_"), "value", F.lit("("), "source", F.lit(")"))
    conflicts = said.join(won, [entity, "dimension"]).filter(F.col("value") != F.col("won.value")).select(entity, F.struct("at.layer", "at.part", order.alias("dimension")).alias("place"), detail.alias("detail"))
    wide = won.groupBy(entity).agg(*(F.max(F.when(F.col("dimension") == d, F.col("won.value"))).alias(d) for d in dimensions))
    seen = rows.select(entity, "at", "seq", F.posexplode("reasons").alias("n", "code")).groupBy(entity, "code").agg(F.min(F.struct("at", "seq", "n")).alias("first"))
    codes = seen.groupBy(entity).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "code"))), lambda x: x["code"]).alias("codes"))
    has = rows.groupBy(entity).agg(*(F.bool_or((F.col("layer") == n) & F.col("value").isNotNull()).alias(f"_{n}") for n in LAYERS))
    split = conflicts.groupBy(entity).agg(F.count("*").alias("n_conflicts"))
    out = has.join(wide, entity, "left").join(codes, entity, "left").join(split, entity, "left").withColumn("n_conflicts", F.coalesce("n_conflicts", F.lit(0)))
    flag = F.when(F.col("n_conflicts") > 0, F.array(F.lit("LICENSE_CONFLICT"))).otherwise(F.array().cast("array<string>"))
    out = out.withColumn("reason_codes", F.concat(F.coalesce("codes", F.array().cast("array<string>")), flag))
    confidence = first_match([(F.col("_url") | F.col("_terms"), "collection"), (F.col("_embedded"), "embedded"), (F.col("_manual"), "manual")], "unknown")
    return out.select(entity, *dimensions, "reason_codes", "n_conflicts", confidence.alias("confidence")), conflicts


def normalize_license(found: DataFrame, entity: str) -> DataFrame:
    """One row an entity: each dimension from its first layer, disagreements as reason codes, and the confidence."""
    rank = first_match([(F.col("layer") == n, i) for i, n in enumerate(LAYERS)], len(LAYERS))
    rows = found.withColumn("rank", rank)
    per = rows.groupBy(entity, "dimension").agg(F.min_by("value", F.struct("rank", "value")).alias("value"), F.count_distinct("value").alias("n"))
    wide = per.groupBy(entity).agg(
        *(F.max(F.when(F.col("dimension") == d, F.col("value"))).alias(d) for d in DIMENSIONS), F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.concat(F.lit("LICENSE_CONFLICT:"), "dimension")))).alias("reason_codes")
    )
    has = rows.groupBy(entity).agg(*(F.bool_or(F.col("layer") == n).alias(f"_{n}") for n in LAYERS))
    out = wide.join(has, entity)
    confidence = first_match([(F.col("_url") | F.col("_terms"), "collection"), (F.col("_embedded"), "embedded"), (F.col("_manual"), "manual")], "unknown")
    return out.withColumn("confidence", confidence).drop(*(f"_{n}" for n in LAYERS))


def first_rule(rules: Sequence[tuple[str, Mapping[str, Sequence[tuple[str, Sequence[object]]]]]], default: str) -> Column:
    """The result of the first rule of which all 'all' and, if given, any 'any' conditions (column, allowed values) hold; null never matches."""
    compiled = []
    for result, parts in rules:
        test = F.lit(True)
        for c, values in parts.get("all", ()):
            test = test & F.coalesce(F.col(c).isin(*values), F.lit(False))
        if parts.get("any"):
            some = F.lit(False)
            for c, values in parts["any"]:
                some = some | F.coalesce(F.col(c).isin(*values), F.lit(False))
            test = test & some
        compiled.append((test, result))
    return first_match(compiled, default)


#: Fixed colour rules; what no rule names is gray, so unknown is never green.
COLOR_RULES = (
    ("green", {"all": [("use_scope", ["everyone"]), ("redistribute_original", ["1"]), ("modify", ["1"]), ("commercial_scope", ["personal_profit", "corporation"])]}),
    ("yellow", {"any": [("use_scope", ["holder", "explicitly_licensed"]), ("commercial_scope", ["personal_non_profit"]), ("redistribute_original", ["0"]), ("corporate_use", ["1"])]}),
    ("red", {"all": [("commercial_scope", ["none"])]}),
)


def color() -> Column:
    return first_rule(COLOR_RULES, "gray")


def _compact(c: Column) -> Column:
    return F.regexp_replace(F.upper(c.cast("string")), "[^A-Z0-9]", "")


def license_category(c: Column) -> Column:
    """Colour of a license text by its name alone; a share-alike license counts as green here."""
    x = _compact(c)
    return first_match([(x.isNull() | (x == ""), "unknown"), (x.startswith("CC0") | x.contains("PUBLICDOMAIN"), "green"), (x.contains("NC") & x.startswith("CC"), "yellow"), (x.startswith("CCBY") | x.startswith("MIT") | x.startswith("APACHE"), "green"), (x.contains("ALLRIGHTSRESERVED"), "red")], "gray")


def license_label(c: Column) -> Column:
    """A display label."""
    x = _compact(c)
    return first_match([(x.isNull() | (x == ""), "Unknown"), (x.startswith("CC0"), "CC0"), (x.startswith("CCBYNC"), "CC BY-NC"), (x.startswith("CCBYSA"), "CC BY-SA"), (x.startswith("CCBY"), "CC BY")], F.trim(c.cast("string")))


def license_gated(category: Column) -> Column:
    """Whether use needs a purchase, by license."""
    return F.when(category == "unknown", None).otherwise(category.isin("yellow", "red"))


def file_gated(access: Column) -> Column:
    """Whether the file needs a purchase, by access and never by license; unknown stays unknown."""
    return F.when(access == "public", False).when(access.isin("holder_gated", "purchase_gated"), True)


def permissions(category: Column) -> Column:
    """Permission flags; unknown for an unknown license."""
    known = category != "unknown"
    return F.struct(F.when(known, category == "green").alias("commercial"), F.when(known, category.isin("green", "yellow")).alias("personal"), F.when(known, category == "green").alias("modify"))
