"""Staging of entities with their children, proofs and identifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import first_match, reasons, text

#: Fixed texts: statuses of a reachable child, and what a contract and a digest look like.
REACHABLE = ("ok_vrm", "ok_glb", "reachable_not_vrm")
SPECS = ("0.x", "1.0")
CONTRACT = "^0x[0-9a-f]{40}$"
DIGEST = "^[0-9a-f]{64}$"
READY, DONE = "ready_for_reconciliation", "reconciled"


def primary_keys(entities: DataFrame, key: str, own: Column, contracts: DataFrame, address: str, is_primary: str, seq: str, evidence: DataFrame | None = None, proven: str = "contract") -> DataFrame:
    """(key, contract, chosen_by): each entity's key: that of its evidence, else its first listed one, primary ones first, else its own."""
    listed = contracts.filter(text(address).isNotNull()).groupBy(key).agg(F.min_by(text(address), F.struct((~F.coalesce(F.col(is_primary), F.lit(False))).alias("p"), F.col(seq).alias("s"))).alias("_listed"))
    out = entities.select(key, text(own).alias("_own")).join(listed, key, "left")
    if evidence is not None:
        out = out.join(evidence.groupBy(key).agg(F.min(text(proven)).alias("_proven")), key, "left")
    else:
        out = out.withColumn("_proven", F.lit(None).cast("string"))
    by = first_match([(F.col("_proven").isNotNull(), "evidence"), (F.col("_listed").isNotNull(), "listed"), (F.col("_own").isNotNull(), "entity")])
    return out.select(key, F.coalesce("_proven", "_listed", "_own").alias("contract"), by.alias("chosen_by"))


def stage_candidates(children: DataFrame, key: str, child: str, url: str, reachable: Column, validated: DataFrame) -> DataFrame:
    """(key, known, candidates, validated): of each entity all children, the distinct URLs of reachable or validated ones, and of these the validated ones.

    Of the children of one URL the first by id that is reachable or validated stands for it. ``validated`` is (child).
    """
    rows = children.join(validated.select(child).distinct().withColumn("_validated", F.lit(True)), child, "left").withColumn("_validated", F.coalesce("_validated", F.lit(False)))
    good = text(url).isNotNull() & (F.coalesce(reachable, F.lit(False)) | F.col("_validated"))
    per = rows.filter(good).groupBy(key, text(url).alias("_url")).agg(F.min_by("_validated", child).alias("_validated"))
    counts = per.groupBy(key).agg(F.count("*").alias("candidates"), F.count_if("_validated").alias("validated"))
    return children.groupBy(key).agg(F.count("*").alias("known")).join(counts, key, "left").select(key, "known", F.coalesce("candidates", F.lit(0)).alias("candidates"), F.coalesce("validated", F.lit(0)).alias("validated"))


def stage_records(entities: DataFrame, key: str, counts: DataFrame, evidence: Column, contract: Column, chain: Column, supported: Sequence[str], storage_only: Sequence[str], excluded: Column, nsfw: Column, gated: Column, banner: Column, picture: Column, supply: Sequence[Column]) -> DataFrame:
    """Entities with blockers, warnings, stage, staged children and coverage.

    ``counts`` is what ``stage_candidates`` gives; ``evidence`` tells whether the entity as a whole has binary proof, without
    which only individually validated children are candidates. ``gated`` is whether use needs a purchase, null if the
    license does not say. A blocker defers; else all known children staged are ``bulk_ready``, some ``partial_ready``, and
    none a preview of the proven sample. Coverage is of the first positive supply, else of the known children.
    """
    out = entities.join(counts, key, "left")
    known, validated = F.coalesce("known", F.lit(0)), F.coalesce("validated", F.lit(0))
    proof = F.coalesce(evidence, F.lit(False))
    candidates = F.when(proof, F.coalesce("candidates", F.lit(0))).otherwise(validated)
    low = F.coalesce(F.lower(text(chain)), F.lit(""))
    mapped = F.when(low.isin(*supported), low)
    wrong = ~low.isin(*supported, *storage_only, "")
    out = out.withColumn("_known", known).withColumn("_candidates", candidates).withColumn("_validated", validated)
    stops = [(F.coalesce(excluded, F.lit(False)), F.lit("owner_excluded")), (F.coalesce(nsfw, F.lit(False)), F.lit("nsfw_requires_review")), (wrong, F.concat(F.lit("unsupported_chain:"), low)), (mapped.isNotNull() & text(contract).isNull(), F.lit("missing_contract")), (~proof & (validated == 0), F.lit("no_binary_validated_vrm"))]
    blockers = F.array_compact(F.array(*(F.when(c, t) for c, t in stops)))
    face = text(picture)
    warnings = reasons(
        ((F.col("_candidates") == 0) & proof, "sample_only"),
        ((F.col("_candidates") > 0) & (F.col("_candidates") < F.col("_known")), "partial_avatar_inventory"),
        (gated.isNull(), "license_requires_review"),
        (text(banner).isNull() & face.isNotNull(), "banner_uses_pfp_fallback"),
        (text(banner).isNull() & face.isNull(), "missing_banner"),
        (face.isNull(), "missing_pfp"),
    )
    staged = F.greatest(F.col("_candidates"), F.lit(1))  # the sample
    total = F.coalesce(*(F.when(s > 0, s) for s in supply), F.when(F.col("_known") > 0, F.col("_known")), staged)
    stage = first_match([(F.size("blockers") > 0, "deferred"), ((F.col("_candidates") > 0) & (F.col("_candidates") == F.col("_known")), "bulk_ready"), (F.col("_candidates") > 0, "partial_ready")], "preview_ready")
    out = out.withColumn("blockers", blockers).withColumn("warnings", warnings).withColumn("stage", stage)
    live = F.col("stage") != "deferred"
    return out.select(*entities.columns, "blockers", "warnings", "stage", F.when(live, staged).alias("staged"), F.col("_known").alias("known"), F.col("_validated").alias("validated"), F.when(live, F.round(staged / total, 6)).cast("double").alias("coverage"))


def complete_proof(status: Column, spec: Column, digest: Column, url: Column, length: Column) -> Column:
    """Whether a hit proves a model: status, spec, digest, address and length all stated."""
    return F.coalesce((status == "valid_vrm") & spec.isin(*SPECS) & digest.rlike(DIGEST) & text(url).isNotNull() & (length > 0), F.lit(False))


def reconcile_proofs(hits: DataFrame, catalog: DataFrame, keys: DataFrame, children: DataFrame, promotions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Hits judged, and what they change: (judged, entities, links, promotions).

    ``hits`` is (entity, chain, contract, canonical_url, transport_url, status, spec, digest, length, observed_at), the
    ``catalog`` (entity, chain, contract, check_status, url), ``keys`` (entity, chain, contract), ``children`` (entity,
    child, url), ``promotions`` (entity, canonical_url, digest, state). A hit counts if its proof is complete and its
    identity is that of the entity: chain equal, and its contract the entity's own or one of its listed ones. It updates an
    unconfirmed entity (of several hits the first by address), links the first child with exactly one of its addresses,
    and turns its own promotion from ready to reconciled. Judged hits carry the outcome or the reason they are refused for.
    """
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    own = catalog.select(F.col("entity").alias("_e"), low("chain").alias("_chain"), low("contract").alias("_contract"))
    listed = keys.select(F.col("entity").alias("_k"), low("chain").alias("_kc"), low("contract").alias("_ka")).distinct()
    rows = hits.withColumn("_c", low("chain")).withColumn("_a", low("contract"))
    rows = rows.join(own, F.col("entity") == F.col("_e"), "left").join(listed, (F.col("entity") == F.col("_k")) & (F.col("_c") == F.col("_kc")) & (F.col("_a") == F.col("_ka")), "left")
    whole = text("entity").isNotNull() & (F.col("_c") != "") & F.col("_a").rlike(CONTRACT)
    judged = first_match(
        [
            (~complete_proof(F.col("status"), F.col("spec"), F.col("digest"), F.col("canonical_url"), F.col("length")), "incomplete_proof"),
            (~whole, "incomplete_hit_identity"),
            (F.col("_e").isNull(), "collection_not_found"),
            (F.col("_chain") != F.col("_c"), "chain_mismatch"),
            (F.col("_contract") == F.col("_a"), "collection_primary_contract"),
            (F.col("_k").isNotNull(), "collection_contract_table"),
        ],
        "contract_mismatch",
    )
    rows = rows.withColumn("identity", judged).withColumn("accepted", F.col("identity").isin("collection_primary_contract", "collection_contract_table")).select(*hits.columns, "identity", "accepted")
    good = rows.filter("accepted").withColumn("_transport", F.coalesce(text("transport_url"), F.col("canonical_url")))
    best = good.groupBy("entity").agg(F.min(F.struct("canonical_url", "_transport", "length", "observed_at")).alias("b"))
    entities = catalog.join(best, "entity", "left")
    confirmed = F.coalesce((F.col("check_status") == "ok_vrm") & text("url").isNotNull(), F.lit(False))
    new = F.col("b").isNotNull() & ~confirmed
    outcome = first_match([(F.col("b").isNull(), "unchanged"), (confirmed, "kept_confirmed")], "updated")
    entities = entities.select(*(c for c in catalog.columns if c not in ("check_status", "url")), F.when(new, "ok_vrm").otherwise(F.col("check_status")).alias("check_status"), F.when(new, F.col("b._transport")).otherwise(F.col("url")).alias("url"), F.when(new, F.col("b.length")).alias("check_bytes"), F.when(new, F.col("b.observed_at")).alias("checked_at"), outcome.alias("outcome"))
    either = good.select("entity", "canonical_url", "digest", F.explode(F.array_distinct(F.array("canonical_url", "_transport"))).alias("url")).distinct()
    links = children.join(either, ["entity", "url"]).groupBy("entity", "canonical_url", "digest").agg(F.min("child").alias("child"))
    done = good.select("entity", "canonical_url", "digest").distinct().withColumn("_done", F.lit(True))
    moved = promotions.join(done, ["entity", "canonical_url", "digest"], "left")
    moved = moved.withColumn("state", F.when(F.col("_done") & (F.col("state") == READY), DONE).otherwise(F.col("state"))).select(*promotions.columns)
    return rows, entities, links, moved


def identifier_rows(promoted: DataFrame, entity: str, namespaces: Mapping[str, Column], extra: Mapping[str, Column]) -> DataFrame:
    """(entity, namespace, value, ...): an identifier row of each namespace that a promoted entity has a value in; ``extra`` columns go with all of them."""
    pairs = F.explode(F.array_compact(F.array(*(F.when(text(c).isNotNull(), F.struct(F.lit(n).alias("namespace"), text(c).alias("value"))) for n, c in namespaces.items()))))
    return promoted.select(F.col(entity).alias("entity"), *(c.alias(n) for n, c in extra.items()), pairs.alias("x")).groupBy("entity", "x.namespace", "x.value").agg(*(F.min(n).alias(n) for n in extra))


def artifact_age(builds: DataFrame, key: str, stamp: str, as_of: Column) -> DataFrame:
    """(key, age_hours, violation): the age of each build's market data, or that its time stamp cannot be read; no stamp, no violation."""
    at = F.try_to_timestamp(F.regexp_replace(F.col(stamp), "Z$", "+00:00"))
    age = F.round((F.unix_micros(as_of) - F.unix_micros(at)) / 3_600_000_000, 1)
    return builds.select(key, age.alias("age_hours"), F.when(F.col(stamp).isNotNull() & at.isNull(), F.concat(F.lit("invalid_market_data_as_of:"), F.col(stamp))).alias("violation"))


def archived_status(status: Column, snapshot: Column) -> Column:
    """A fetch status, ``archived`` where a page is gone and a snapshot of it is known."""
    return F.when(status.isin("dead", "http_404", "http_410", "soft_404") & text(snapshot).isNotNull(), "archived").otherwise(status)


def evidence_queue(failures: DataFrame, key: str, name: str, fields: str, priorities: Mapping[str, int], other: int, plans: Mapping[str, Sequence[str]], research: DataFrame, actions: Mapping[str, Sequence[tuple[Column, str | Column]]]) -> DataFrame:
    """Entities by their most urgent missing field, the number of fields and name, with the plan of each field.

    ``actions`` of a field are (condition on the research of the entity, what to do): those that hold come first, in
    order, then the field's general plan, each once. Research of several rows an entity is united by its largest values.
    """
    facts = [c for c in research.columns if c != key]
    one = research.groupBy(key).agg(*(F.max(c).alias(c) for c in facts))
    rows = failures.select(key, name, F.explode(F.array_distinct(fields)).alias("field")).join(one, key, "left")
    general = lambda f: F.array(*(F.lit(p) for p in plans.get(f, ()))).cast("array<string>")
    first = lambda f: F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), a if isinstance(a, Column) else F.lit(a)) for c, a in actions.get(f, ())))).cast("array<string>")
    default = F.array(F.lit("authoritative project source"), F.lit("archived source"))
    known = sorted({*plans, *actions})
    plan = first_match([(F.col("field") == f, F.array_distinct(F.concat(first(f), general(f)))) for f in known], default)
    rank = first_match([(F.col("field") == f, p) for f, p in priorities.items()], other)
    rows = rows.withColumn("plan", plan).withColumn("rank", rank)
    out = rows.groupBy(key, name).agg(F.max("rank").alias("priority"), F.count("*").alias("n_fields"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "plan")))).alias("plans"))
    return out.orderBy(F.desc("priority"), F.desc("n_fields"), F.lower(F.col(name)), key)
