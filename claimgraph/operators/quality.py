"""Evidence, audits, gates and stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import any_of, first_match, reasons, text

#: Fixed states and patterns.
TERMINAL_STATES = ("none", "not_applicable", "unavailable", "permanently_closed")
SECRET_PATTERNS = (r"AKIA[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36}", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"(?i)(api[_-]?key|secret|token|password)\s*[:=]\s*[A-Za-z0-9+/_.=-]{12,}")


def resolve_field(value: Column, state: Column, has_evidence: Column, valid: Column | None = None) -> Column:
    """A field's verdict: a concrete value beats an explicit state with evidence, which beats missing."""
    concrete = text(value).isNotNull() & (F.lit(True) if valid is None else F.coalesce(valid, F.lit(False)))
    stated = text(state).isNotNull() & F.coalesce(has_evidence, F.lit(False))
    return F.struct(
        F.when(concrete | stated, True).otherwise(False).alias("ok"),
        F.when(concrete, "value").when(stated, state.cast("string")).otherwise("missing").alias("state"),
        F.when(concrete, text(value)).alias("value"),
        F.when(concrete, "catalog").when(stated, "research").otherwise("none").alias("source"),
    )


def inventory_state(state: Column, evidence: Column, researched: Column, discovered: Column, base_complete: Column) -> Column:
    """complete, partial or unknown, from a terminal or complete state with evidence, a complete base lane, and any asset."""
    assets = F.coalesce(researched, F.lit(0)) + F.coalesce(discovered, F.lit(0))
    proven = F.coalesce(evidence, F.lit(False))
    return first_match(
        [
            (state.isin(*TERMINAL_STATES) & proven & (assets == 0), "complete"),
            ((state == "complete") & proven & (F.coalesce(researched, F.lit(0)) > 0), "complete"),
            (F.coalesce(base_complete, F.lit(False)) & (assets > 0), "complete"),
            (assets > 0, "partial"),
        ],
        "unknown",
    )


def storage_type(url: Column) -> Column:
    """Storage class of one URL."""
    low = F.lower(url)
    return F.when(text(url).isNull(), None).otherwise(
        first_match(
            [
                (low.startswith("ipfs://") | low.contains("/ipfs/"), "ipfs"),
                (low.startswith("ar://") | low.contains("arweave.net/"), "arweave"),
                (low.startswith("data:"), "onchain"),
                (low.rlike("^https?://"), "http"),
            ],
            "unknown",
        )
    )


def storage_types(urls: Column, override: Column | None = None) -> Column:
    """Sorted storage classes of an array of URLs; an explicit override wins."""
    found = F.array_sort(F.array_distinct(F.array_compact(F.transform(urls, storage_type))))
    return found if override is None else F.when(text(override).isNotNull(), F.array(text(override))).otherwise(found)


def rights_known(terms: Sequence[Column], dimensions: Sequence[Column], unknown: Sequence[str] = ("unknown", "unspecified")) -> Column:
    """Whether any term or license dimension says something."""
    return any_of([F.coalesce(text(c).isNotNull() & ~F.lower(text(c)).isin(*unknown), F.lit(False)) for c in (*terms, *dimensions)])


def access_mode(override: Column, evidence: Column, rows: Column, public_rows: Column, complete: Column, expected: Column, validated_url: Column) -> Column:
    """public only on proof: an override with evidence, all children public and coverage complete, or one validated asset; never from a license."""
    return first_match(
        [
            (text(override).isNotNull() & F.coalesce(evidence, F.lit(False)), text(override)),
            ((rows > 0) & (public_rows == rows) & F.coalesce(complete, F.lit(False)), "public"),
            ((expected == 1) & text(validated_url).isNotNull(), "public"),
        ],
        "unknown",
    )


def promote_access(mode: Column, state: Column, urls: Column, probe_complete: Column, valid: Column) -> Column:
    """Public, where every URL of a complete inventory was probed valid and no mode is set yet."""
    proven = (state == "complete") & (urls > 0) & probe_complete & (valid == urls)
    return F.when(text(mode).isNotNull(), text(mode)).when(proven, "public")


def audit(df: DataFrame, key: str, verdicts: Mapping[str, Column]) -> DataFrame:
    """All verdicts, the fields that are missing, and whether the row is complete."""
    ok = {n: F.coalesce(v, F.lit(False)) for n, v in verdicts.items()}
    missing = reasons(*((~v, n) for n, v in ok.items()))
    return df.select(key, *(v.alias(f"ok_{n}") for n, v in ok.items()), missing.alias("missing")).withColumn("complete", F.size("missing") == 0)


def gate(df: DataFrame, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    """Each row's reasons to fail, and whether it passes."""
    return df.withColumn("reasons", reasons(*rules)).withColumn("passed", F.size("reasons") == 0)


def gate_summary(gated: DataFrame, omissions: DataFrame) -> DataFrame:
    """Passing over the whole scope: omitted leads count in the denominator and fail."""
    rows = gated.agg(F.count("*").alias("audited"), F.count_if(~F.col("passed")).alias("failing"))
    lost = omissions.agg(F.count("*").alias("omitted"))
    both = rows.withColumn("one", F.lit(1)).join(lost.withColumn("one", F.lit(1)), "one").drop("one")
    return both.withColumn("denominator", F.col("audited") + F.col("omitted")).withColumn("passing", F.col("audited") - F.col("failing"))


def readiness(df: DataFrame, critical: Mapping[str, Column], completeness: Mapping[str, Column], near: int = 6) -> DataFrame:
    """Score 0-8 of critical and completeness criteria; ready if all critical ones hold, near-ready from a score on."""
    flags = {n: F.coalesce(c, F.lit(False)) for n, c in {**critical, **completeness}.items()}
    out = df.select("*", *(c.alias(n) for n, c in flags.items()))
    score = sum((F.col(n).cast("int") for n in flags), F.lit(0))
    ready = F.lit(True)
    for n in critical:
        ready = ready & F.col(n)
    out = out.withColumn("score", score).withColumn("ready", ready)
    return out.withColumn("near_ready", ~F.col("ready") & (F.col("score") >= near))


def blockers(ready: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """How many rows each criterion blocks."""
    one = ready.agg(*(F.count_if(~F.col(c)).alias(c) for c in criteria)).withColumn("_", F.lit(0))
    return one.unpivot("_", list(criteria), "criterion", "blocked").drop("_")


def verify_artifacts(artifacts: DataFrame, canonical: DataFrame, key: str, snapshot: str, fields: Sequence[str]) -> DataFrame:
    """Violations: another snapshot id, an unknown key, or a canonical field that differs."""
    base = canonical.select(key, F.col(snapshot).alias("_snapshot"), *(F.col(f).alias(f"_{f}") for f in fields))
    out = artifacts.join(base, key, "left")
    rules = [(F.col("_snapshot").isNull(), "unknown_key"), (F.col(snapshot) != F.col("_snapshot"), "snapshot_mismatch")]
    rules += [(~F.col(f).eqNullSafe(F.col(f"_{f}")) & F.col("_snapshot").isNotNull(), f"differs:{f}") for f in fields]
    return out.select(key, F.explode(reasons(*rules)).alias("violation"))


def secret_scan(df: DataFrame, key: str, c: str, patterns: Sequence[str] = SECRET_PATTERNS) -> DataFrame:
    """Rows whose text looks as if it held a secret, with the number of patterns that match."""
    hits = sum((F.coalesce(F.col(c).rlike(p), F.lit(False)).cast("int") for p in patterns), F.lit(0))
    return df.select(key, hits.alias("patterns")).filter("patterns > 0")


def stage(df: DataFrame, blocked: Sequence[tuple[Column, str]], known: Column, candidates: Column, expected: Column) -> DataFrame:
    """deferred with its blockers, else bulk_ready, partial_ready or preview_ready, and coverage to six places."""
    known, candidates = F.coalesce(known, F.lit(0)), F.coalesce(candidates, F.lit(0))
    out = df.withColumn("blockers", reasons(*blocked))
    name = first_match([(F.size("blockers") > 0, "deferred"), ((known > 0) & (candidates == known), "bulk_ready"), (candidates > 0, "partial_ready")], "preview_ready")
    total = F.coalesce(F.when(expected > 0, expected), F.when(known > 0, known))
    share = F.when(total.isNull(), 1.0).otherwise(F.round(candidates / total, 6))
    return out.withColumn("stage", name).withColumn("coverage", share.cast("double"))


def bundle_summary(df: DataFrame, stage_col: str) -> DataFrame:
    return df.groupBy(stage_col).agg(F.count("*").alias("n"))


def validate_bundle(df: DataFrame, key: str, checks: Mapping[str, Column]) -> DataFrame:
    """Violations of a bundle by key: repeated keys and failed checks; an unknown check fails."""
    twice = df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key, F.lit("duplicate_key").alias("violation"))
    failed = df.select(key, F.explode(reasons(*((~F.coalesce(c, F.lit(False)), n) for n, c in checks.items()))).alias("violation"))
    return twice.unionByName(failed)


def supply_status(total: Column, most: Column, age_days: Column) -> tuple[Column, Column]:
    """Status and progress of an issue: capped, ongoing, likely_capped by age, no_max_supply or unknown."""
    status = first_match(
        [(total.isNotNull() & most.isNotNull() & (most > 0) & (total >= most), "capped"), (total.isNotNull() & most.isNotNull() & (total > 0), "ongoing"), (total.isNotNull() & (total > 0) & (age_days > 365), "likely_capped"), (total.isNotNull() & (total > 0), "no_max_supply")], "unknown"
    )
    progress = F.when((most > 0) & (total > 0) & (total < most), F.round(total * 100.0 / most, 1))
    return status, progress


def number_in_text(c: Column) -> Column:
    """The first number of a text that is neither under 10 nor looks like a year beside a word for time."""
    numbers = F.regexp_extract_all(c, F.lit(r"((?:in|since|year|from)\s+)?(\d[\d,]*)"), F.lit(0))
    value = lambda x: F.regexp_replace(F.regexp_extract(x, r"(\d[\d,]*)", 1), ",", "").try_cast("bigint")
    fine = F.filter(numbers, lambda x: (value(x) >= 10) & ~(x.rlike(r"^(in|since|year|from)\s") & value(x).between(1900, 2100)))
    return value(F.get(fine, F.lit(0)))


def sanitize(df: DataFrame, scope: str, evidence: str, item_fields: Sequence[str]) -> DataFrame:
    """Evidence of an entity without fields that name one item."""
    blank = F.transform(evidence, lambda e: _nulled(e, item_fields))
    return df.withColumn(evidence, F.when(F.col(scope) == "entity", blank).otherwise(F.col(evidence)))


def _nulled(e: Column, names: Sequence[str]) -> Column:
    for n in names:
        e = e.withField(n, F.lit(None).cast("string"))
    return e


#: Fixed classes of links with their severities, and which error classes each rule names.
LINK_SEVERITIES = {
    "healthy": "info",
    "healthy_with_transport_degradation": "warning",
    "non_vrm_glb": "error",
    "not_glb": "error",
    "invalid_glb": "error",
    "validation_rejected": "error",
    "missing": "error",
    "access_blocked": "error",
    "blocked_or_invalid_uri": "error",
    "unstable_transport": "warning",
    "transient_transport_failure": "warning",
    "unclassified_error": "error",
}
VALIDATION_CLASSES = {"valid_glb_not_vrm": "non_vrm_glb", "not_glb": "not_glb", "invalid_glb": "invalid_glb"}
MISSING_ERRORS = ("http_404", "http_410")
ACCESS_ERRORS = ("http_401", "http_403")
URI_ERRORS = ("blocked_destination", "blocked_uri", "unsupported_scheme", "invalid_uri")
TRANSIENT_ERRORS = ("timeout", "dns_or_conn", "server_error", "rate_limited")


def classify_link(valid: Column, status: Column, probe_failures: Column, probe_successes: Column, fallback: Column, errors: Column) -> tuple[Column, Column]:
    """Class and severity of a link.

    ``valid`` is the outcome of its validation, null if there was none, ``status`` its status; the numbers of probes that
    failed and succeeded, whether validation used another transport than the first, and the error classes of probes and
    validation. A validation decides alone; without one the error classes do, in this order: all missing, all forbidden,
    any of a bad address, any error beside a probe that succeeded, any transient one.
    """
    errors = F.filter(F.coalesce(errors, F.array().cast("array<string>")), lambda e: e.isNotNull() & (e != ""))
    some = F.size(errors) > 0
    named = lambda names: F.array(*(F.lit(n) for n in names))
    only = lambda names: some & (F.size(F.array_except(errors, named(names))) == 0)
    health = first_match(
        [
            (valid & ((F.coalesce(probe_failures, F.lit(0)) > 0) | F.coalesce(fallback, F.lit(False))), "healthy_with_transport_degradation"),
            (valid, "healthy"),
            *((valid.isNotNull() & (status == s), c) for s, c in VALIDATION_CLASSES.items()),
            (valid.isNotNull(), "validation_rejected"),
            (only(MISSING_ERRORS), "missing"),
            (only(ACCESS_ERRORS), "access_blocked"),
            (F.arrays_overlap(errors, named(URI_ERRORS)), "blocked_or_invalid_uri"),
            (some & (F.coalesce(probe_successes, F.lit(0)) > 0), "unstable_transport"),
            (F.arrays_overlap(errors, named(TRANSIENT_ERRORS)), "transient_transport_failure"),
        ],
        "unclassified_error",
    )
    return health, F.element_at(F.create_map(*(F.lit(x) for pair in LINK_SEVERITIES.items() for x in pair)), health)


def fetch_status(code: Column, content_ok: Column, error: Column, body: Column) -> Column:
    """ok, not_model, soft_404, http_4xx, http_5xx, timeout, dns or error."""
    low = F.lower(F.coalesce(error, F.lit("")))
    return first_match(
        [
            (low.contains("timeout") | low.contains("timed out"), "timeout"),
            (low.contains("dns") | low.contains("resolve"), "dns"),
            (text(error).isNotNull(), "error"),
            (code.between(400, 499), "http_4xx"),
            (code >= 500, "http_5xx"),
            (F.lower(F.coalesce(body, F.lit(""))).rlike("page not found|does not exist|no longer available"), "soft_404"),
            (F.coalesce(content_ok, F.lit(False)), "ok"),
        ],
        "not_model",
    )


def transfer_evidence(df: DataFrame, key: str, item: str, uri: str, signal: Column, error: str) -> DataFrame:
    """Items sampled, distinct ids and URIs, signals and errors by entity."""
    return df.groupBy(key).agg(F.count("*").alias("sampled"), F.count_distinct(item).alias("items"), F.count_distinct(uri).alias("uris"), F.count_if(signal).alias("signals"), F.count(error).alias("errors"), F.count_distinct(error).alias("error_kinds"))


def tree_inventory(tree: DataFrame, path: str, root: str, suffix: str, evidence: Column) -> DataFrame:
    """Files under a root, with the sidecar each should have and evidence found in it: ok, no_sidecar or no_evidence."""
    files = tree.filter(F.col(path).startswith(root) & F.col(path).endswith(suffix)).select(path)
    sidecars = tree.withColumn("evidence", evidence).select(F.col(path).alias("_side"), "evidence")
    out = files.join(sidecars, F.concat(F.col(path), F.lit(".meta")) == F.col("_side"), "left")
    return out.select(path, first_match([(F.col("_side").isNull(), "no_sidecar"), (~F.coalesce("evidence", F.lit(False)), "no_evidence")], "ok").alias("state"))


def promote_validated(leads: DataFrame, key: str, valid: Column, entity_id: Column, catalog: DataFrame, catalog_id: str) -> tuple[DataFrame, DataFrame]:
    """Validated leads that the catalog lacks, with their derived ids; and how many were checked, imported and skipped."""
    rows = leads.withColumn("entity_id", entity_id).withColumn("_valid", F.coalesce(valid, F.lit(False)))
    known = catalog.select(F.col(catalog_id).alias("entity_id")).distinct().withColumn("_known", F.lit(True))
    rows = rows.join(known, "entity_id", "left")
    fresh = rows.filter(F.col("_valid") & F.col("_known").isNull())
    counts = rows.agg(F.count("*").alias("checked"), F.count_if(F.col("_valid") & F.col("_known").isNull()).alias("imported"), F.count_if(~F.col("_valid") | F.col("_known").isNotNull()).alias("skipped"))
    return fresh.select(key, "entity_id").distinct(), counts


