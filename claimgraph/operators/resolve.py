"""Joins and entity resolution that refuse ambiguous matches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import first_match
from ..functions.shared import cut


def _keys(df: DataFrame, id_col: str, name: str, keys: Sequence[Column]) -> DataFrame:
    """(id, rank, k): the keys that each row has, by the rank of their rule."""
    have = F.filter(F.array(*(F.struct(F.lit(i).alias("rank"), c.cast("string").alias("k")) for i, c in enumerate(keys))), lambda x: x["k"].isNotNull())
    return df.select(F.col(id_col).alias(name), F.explode(have).alias("x")).select(name, "x.rank", "x.k")


def first_come(keyed: DataFrame) -> DataFrame:
    """(lead, rank, k): the keys of the leads that are taken if leads come in order and one that shares a key with a taken one is not.

    A round takes every lead that is the first under all its keys and sets aside those that share a key with it, so that
    the rounds are as many as the longest chain of leads that wait for each other, and each is two joins of the leads left.
    """
    left, taken = keyed, keyed.limit(0)
    while not left.isEmpty():
        first = left.groupBy("rank", "k").agg(F.min("lead").alias("first"))
        own = left.join(first, ["rank", "k"])
        free = own.groupBy("lead").agg(F.bool_and(F.col("first") == F.col("lead")).alias("free")).filter("free")
        # a key is taken if the lead that comes first in it is free
        own = own.join(free, "lead", "left").join(free.select(F.col("lead").alias("first"), F.col("free").alias("met")), "first", "left")
        gone = own.groupBy("lead").agg(F.bool_or(F.coalesce("met", F.lit(False))).alias("gone"))
        state = cut(own.join(gone, "lead").select("lead", "rank", "k", F.coalesce("free", F.lit(False)).alias("free"), "gone"), "round")
        taken = taken.unionByName(state.filter("free").drop("free", "gone"))
        left = state.filter("not gone").drop("free", "gone")
    return taken


def cascade_match(leads: DataFrame, lead_id: str, catalog: DataFrame, entity: str, rules: Sequence[tuple[str, Column, Column]], among_leads: bool = True) -> DataFrame:
    """Each lead's match by the first rule that finds one: entity (null if none), same_as_lead and matched_by.

    A rule is (name, key of the lead, key of the catalog). Several entities under one key: the smallest id. Leads are
    taken in the order of their ids: one that matches nothing is new, and from then on counts as an entity for later leads
    ('lead:' and the rule); one that matched is none, so a lead never matches it.
    """
    names = F.array(*(F.lit(n) for n, _, _ in rules))
    keyed = cut(_keys(leads, lead_id, "lead", [k for _, k, _ in rules]), "keys")
    index = _keys(catalog, entity, "entity", [k for _, _, k in rules]).groupBy("rank", "k").agg(F.min("entity").alias("entity"))
    found = keyed.join(index, ["rank", "k"]).select("lead", "rank", "entity").withColumn("same_as_lead", F.lit(None).cast(dict(leads.dtypes)[lead_id]))
    if among_leads:
        found = cut(found, "found")
        new = first_come(keyed.join(found.select("lead").distinct(), "lead", "left_anti"))
        earlier = keyed.join(new.select(F.col("lead").alias("same_as_lead"), "rank", "k"), ["rank", "k"]).filter("same_as_lead < lead")
        found = found.unionByName(earlier.select("lead", "rank", F.lit(None).cast(dict(found.dtypes)["entity"]).alias("entity"), "same_as_lead"))
    best = found.groupBy("lead").agg(F.min(F.struct("rank", "entity", "same_as_lead")).alias("b"))
    own = {f"_{n}": F.col(f"b.{n}") for n in ("rank", "entity", "same_as_lead")}
    out = leads.join(best.select("lead", *(c.alias(n) for n, c in own.items())), F.col(lead_id) == F.col("lead"), "left")
    by = F.when(F.col("_rank").isNull(), "new").otherwise(F.concat(F.when(F.col("_same_as_lead").isNotNull(), "lead:").otherwise(""), names[F.col("_rank")]))
    return out.select(*leads.columns, F.col("_entity").alias("entity"), F.col("_same_as_lead").alias("same_as_lead"), by.alias("matched_by"))


def presence(catalog: DataFrame, entity: str, other: DataFrame, keys: Sequence[tuple[Column, Column]], rows: str, optimised: str) -> DataFrame:
    """onboarded (more than one row and all optimised), partial (any other match) or absent, by the first key that matches."""
    found = None
    for i, (own, their) in enumerate(keys):
        index = other.select(their.alias("k"), F.col(rows).alias("n"), F.col(optimised).alias("o")).filter("k is not null").groupBy("k").agg(F.sum("n").alias("n"), F.sum("o").alias("o"))
        one = catalog.select(entity, own.alias("k")).filter("k is not null").join(index, "k").select(entity, F.lit(i).alias("rank"), "n", "o")
        found = one if found is None else found.unionByName(one)
    best = found.groupBy(entity).agg(F.min(F.struct("rank", "n", "o")).alias("b")).select(entity, "b.rank", "b.n", "b.o")
    state = F.when(F.col("n").isNull(), "absent").when((F.col("n") > 1) & (F.col("o") >= F.col("n")), "onboarded").otherwise("partial")
    return catalog.select(entity).join(best, entity, "left").select(entity, state.alias("presence"), F.coalesce("n", F.lit(0)).alias("n_rows"))


def unique_index(df: DataFrame, key: str, entity: str) -> DataFrame:
    """Key to its only entity; a key that several entities hold resolves to null."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.when(F.count_distinct(entity) == 1, F.max(entity)).alias("entity"), F.count_distinct(entity).alias("holders"))


def bind(records: DataFrame, record_id: str, supplied: str, keys: str, known: DataFrame, entity: str, owners: DataFrame, key: str, curated: DataFrame) -> DataFrame:
    """Bind records without guessing: a known supplied id, else the one entity that all matched keys name, else the curated id.

    ``keys`` is an array column, ``owners`` maps key to entity, ``curated`` maps record_id to entity. Diagnostics say why not.
    """
    ids = known.select(F.col(entity).alias("known_id")).distinct()
    base = records.join(ids, records[supplied] == F.col("known_id"), "left")
    by_key = records.select(record_id, F.explode(keys).alias(key)).join(owners.select(key, entity), key).groupBy(record_id).agg(F.min(entity).alias("low"), F.max(entity).alias("high"))
    conflict = curated.groupBy(record_id).agg(F.count_distinct(entity).alias("n"), F.min(entity).alias("curated_id"))
    hand = conflict.select(record_id, F.when(F.col("n") > 1, F.raise_error(F.lit("the curated map gives one record several entities")).cast(dict(curated.dtypes)[entity])).otherwise(F.col("curated_id")).alias("curated_id"))
    out = base.join(by_key, record_id, "left").join(hand, record_id, "left")
    ambiguous = F.col("low").isNotNull() & (F.col("low") != F.col("high"))
    chosen = F.coalesce(F.col("known_id"), F.when(~F.coalesce(ambiguous, F.lit(False)), F.coalesce("low", "curated_id")))
    note = first_match(
        [
            (F.col("known_id").isNotNull(), None),
            (ambiguous, F.concat(F.lit("ambiguous_contract_binding:"), F.col("low").cast("string"), F.lit(","), F.col("high").cast("string"))),
            (chosen.isNull(), "no_explicit_binding"),
            (F.col(supplied).isNotNull(), "unknown_supplied_id"),
        ]
    )
    return out.select(*records.columns, chosen.alias("bound_to"), note.alias("diagnostic"))


def guarded_resolve(df: DataFrame, key: str, sub_key: str, shared: DataFrame, records: DataFrame, entity: str) -> DataFrame:
    """A shared key needs a sub-key: the exact sub-key, else the key's only record if the key is not shared, else unresolved with the reason."""
    exact = records.groupBy(key, sub_key).agg(F.min(entity).alias("exact"))
    only = unique_index(records, key, entity).select(key, F.col("entity").alias("only"))
    flag = shared.select(key).distinct().withColumn("shared", F.lit(True))
    out = df.join(exact, [key, sub_key], "left").join(only, key, "left").join(flag, key, "left")
    is_shared = F.coalesce("shared", F.lit(False))
    found = F.when(is_shared, F.col("exact")).otherwise(F.coalesce("exact", "only"))
    error = F.when(found.isNotNull(), None).when(is_shared & F.col(sub_key).isNull(), "shared_key_without_sub_key").when(is_shared, "shared_key_unresolved").otherwise("unresolved")
    return out.select(*df.columns, found.alias("resolved"), error.alias("error"))


def majority(df: DataFrame, key: str, label: str, seq: str) -> DataFrame:
    """The commonest label of each key; ties go to the one seen first."""
    votes = df.filter(F.col(label).isNotNull()).groupBy(key, label).agg(F.count("*").alias("votes"), F.min(seq).alias("seen"))
    return votes.groupBy(key).agg(F.max_by(F.struct(label, "votes"), F.struct("votes", -F.col("seen"))).alias("b")).select(key, f"b.{label}", "b.votes")


def _name_keys(names: DataFrame, *more: str) -> DataFrame:
    """(k, *more) of ``names`` with a column n: the words of over four letters, the pairs of words and the whole name.

    A word meets the words behind it in its own name, so that a very long name is never one array of its pairs.
    """
    words = F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower("n"), "[^a-z0-9]+", " "), " "), lambda w: w != "")))
    own = names.select(*more, words.alias("words")).select(*more, "words", F.posexplode("words").alias("at", "w"))
    single = own.filter(F.length("w") > 4).select(F.col("w").alias("k"), *more)
    pairs = own.select("w", F.explode(F.slice("words", F.col("at") + 2, F.size("words"))).alias("v"), *more).select(F.concat_ws(" ", "w", "v").alias("k"), *more)
    return single.unionByName(pairs).unionByName(names.select(F.concat(F.lit("="), "n").alias("k"), *more))


def token_match(a: DataFrame, a_id: str, b: DataFrame, b_id: str, name: str) -> DataFrame:
    """(id, first): rows of ``a`` whose name equals, or shares two words or one word of more than four letters with, that of a row of ``b``; the smallest.

    Every such word, pair of words and whole name is a key with its smallest id, so a word in every name costs a row each
    and no pairs. Keys are those of distinct names. The joins are hinted, as Spark judges exploded rows by the size of
    the file that they come from, and would broadcast them however many they are.
    """
    ours = a.filter(F.col(name).isNotNull()).select(F.col(a_id).alias("id"), F.col(name).alias("n"))
    theirs = b.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("n")).agg(F.min(b_id).alias("id"))
    first = _name_keys(theirs, "id").groupBy("k").agg(F.min("id").alias("first"))
    best = _name_keys(ours.select("n").distinct(), "n").join(first.hint("merge"), "k").groupBy("n").agg(F.min("first").alias("first"))
    return ours.join(best.hint("merge"), "n").groupBy("id").agg(F.min("first").alias("first"))


def token_duplicates(df: DataFrame, id_col: str, name: str) -> DataFrame:
    """(id, first): as ``token_match``, of rows with an earlier row of the same table."""
    return token_match(df, id_col, df, id_col, name).filter("first < id")


def _pieces(df: DataFrame, name: str) -> DataFrame:
    """``df`` with each piece ``g`` of one to three characters of the names."""
    pieces = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length(name)), lambda i: F.array(*(F.substring(name, i, F.lit(k)) for k in (1, 2, 3))))))
    return df.withColumn("g", F.explode(pieces))


def _holding(whole: DataFrame, w: str, part: DataFrame, p: str) -> DataFrame:
    """``part`` and ``whole`` of names of over three characters and longer ones that hold them, joined on the part's rarest piece."""
    often = whole.groupBy("g").agg(F.count("*").alias("n"))
    own = _pieces(part.filter(F.length(p) > 3), p).filter(F.length("g") == 3)
    # a part of which some piece is in no name is held by none
    rare = own.join(often, "g", "left").groupBy(*part.columns).agg(F.min_by("g", F.struct(F.coalesce("n", F.lit(0)), "g")).alias("g"))
    return whole.join(rare, "g").filter(F.contains(w, p))


def contains_match(a: DataFrame, a_id: str, a_name: Column, b: DataFrame, b_id: str, b_name: Column) -> DataFrame:
    """The first entity of ``b`` (by id) whose name contains the other's, or is contained in it; empty names match nothing.

    Distinct names meet on pieces of up to three characters. A name that is such a piece itself is looked up among them,
    with the smallest id of all names that hold it, so that a common short name costs a row for each name and no pairs; of
    a longer name only the rarest piece is joined.
    """
    left = a.select(F.col(a_id).alias("left_id"), a_name.alias("ln")).filter(F.length("ln") > 0)
    right = b.select(F.col(b_id).alias("right_id"), b_name.alias("rn")).filter(F.length("rn") > 0).groupBy("rn").agg(F.min("right_id").alias("right_id"))
    one = left.select("ln").distinct()
    ours, theirs = _pieces(one, "ln"), _pieces(right, "rn")
    short = lambda df, c: df.filter(F.length(c) <= 3).withColumnRenamed(c, "g")
    found = [
        ours.join(short(right, "rn"), "g").select("ln", "right_id"),
        short(one, "ln").join(theirs.groupBy("g").agg(F.min("right_id").alias("right_id")), "g").select(F.col("g").alias("ln"), "right_id"),
        _holding(ours, "ln", right, "rn").select("ln", "right_id"),
        _holding(theirs, "rn", one, "ln").select("ln", "right_id"),
    ]
    best = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3]).groupBy("ln").agg(F.min("right_id").alias("right_id"))
    return left.join(best, "ln").groupBy("left_id").agg(F.min("right_id").alias("right_id"))


def find_missing(candidates: Sequence[DataFrame], key: str, name: Column, catalog: DataFrame) -> DataFrame:
    """Candidates of all sources, once by key or else name, that the catalog has by neither."""
    rows = None
    for df in candidates:
        rows = df if rows is None else rows.unionByName(df)
    rows, have = rows.withColumn("name_key", name), catalog.withColumn("name_key", name)
    once = rows.withColumn("id_key", F.coalesce(F.col(key).cast("string"), F.col("name_key")))
    once = once.groupBy("id_key").agg(F.min(F.struct(*rows.columns)).alias("r")).select("r.*")
    return once.join(have.select(key).filter(F.col(key).isNotNull()), key, "left_anti").join(have.select("name_key"), "name_key", "left_anti").drop("name_key")


def verify_identity(hits: DataFrame, catalog: DataFrame, entity: str, group: str, key: str, keys: DataFrame) -> DataFrame:
    """Reason code of each hit: incomplete, not_found, group_mismatch, primary, secondary or mismatch."""
    base = catalog.select(F.col(entity), F.col(group).alias("own_group"), F.col(key).alias("own_key"))
    second = keys.select(entity, F.col(key).alias("any_key")).distinct()
    out = hits.join(base, entity, "left").join(second, (hits[entity] == second[entity]) & (hits[key] == second["any_key"]), "left").drop(second[entity])
    code = first_match(
        [
            (F.col(entity).isNull() | F.col(key).isNull() | F.col(group).isNull(), "incomplete"),
            (F.col("own_group").isNull(), "not_found"),
            (F.col("own_group") != F.col(group), "group_mismatch"),
            (F.col("own_key") == F.col(key), "primary"),
            (F.col("any_key").isNotNull(), "secondary"),
        ],
        "mismatch",
    )
    return out.select(*(F.col(c) for c in hits.columns), code.alias("reason"))


def url_identity_conflicts(registry: DataFrame, url: Column, key: str, catalog: DataFrame, catalog_url: Column, catalog_keys: str) -> DataFrame:
    """Registry rows whose normalised URL the catalog binds to other keys."""
    have = catalog.select(catalog_url.alias("u"), F.col(catalog_keys).alias("bound")).filter("u is not null")
    return registry.withColumn("u", url).join(have, "u").filter(~F.array_contains("bound", F.col(key)))


def key_scope(sources: Sequence[DataFrame], entity: str, chain: str, address: str, primary: str, attributes: Sequence[str]) -> DataFrame:
    """All keys of an entity once: primary if any source says so, attributes from the first source that has them."""
    rows = None
    for i, df in enumerate(sources):
        one = df.select(entity, chain, F.lower(F.col(address).cast("string")).alias(address), primary, *attributes).withColumn("source_rank", F.lit(i))
        rows = one if rows is None else rows.unionByName(one)
    best = [F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("source_rank", c))).alias(c) for c in attributes]
    return rows.groupBy(entity, chain, address).agg(F.coalesce(F.bool_or(primary), F.lit(False)).alias(primary), F.min("source_rank").alias("source_rank"), *best)


def merge_duplicates(df: DataFrame, key: str, order: str, cols: Sequence[str]) -> DataFrame:
    """One row a key: of each column the first value, in order, that is not blank."""
    usable = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return df.groupBy(key).agg(F.count("*").alias("merged"), *(F.min_by(c, F.when(usable(c), F.col(order))).alias(c) for c in cols))


def follow_renames(renames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loser, survivor) with chains followed to their end; and the renames refused, with the reason.

    Pointers jump: each round a loser points to what its survivor points to, so that a chain of any length ends in rounds
    of the logarithm of its length. A loser with several survivors is ambiguous and stays as it is, also as the end of
    other chains; losers on a cycle, or that lead into one, have no end and are refused. The joins are hinted, as the
    tables written here are small only on disk: ids compress well, and broadcast they would all pass through the driver.
    """
    pairs = renames.select("loser", "survivor").filter("loser is not null and survivor is not null").groupBy("loser").agg(F.min("survivor").alias("survivor"), F.max("survivor").alias("other"))
    pairs = cut(pairs, "renames")
    at = pairs.filter("survivor = other").select("loser", "survivor")
    for _ in range(max(1, at.count()).bit_length() + 1):
        on = at.select(F.col("loser").alias("survivor"), F.col("survivor").alias("next"))
        at = cut(at.join(on.hint("merge"), "survivor", "left").select("loser", F.coalesce("next", "survivor").alias("survivor"), F.col("next").isNotNull().alias("moved")), "followed")
        if at.filter("moved").isEmpty():
            break
        at = at.select("loser", "survivor")
    endless = at.join(at.select(F.col("loser").alias("survivor")).hint("merge"), "survivor", "left_semi").select("loser")
    reason = endless.select("loser", F.lit("cycle").alias("reason")).unionByName(pairs.filter("survivor <> other").select("loser", F.lit("several_survivors").alias("reason")))
    return at.select("loser", "survivor").join(endless.hint("merge"), "loser", "left_anti"), reason


def merge_entities(children: DataFrame, key: str, renames: DataFrame, child_key: Sequence[str]) -> DataFrame:
    """Children of merged entities point to the last survivor; those that then collide are dropped. ``renames`` has loser, survivor."""
    moved = children.join(follow_renames(renames)[0].hint("merge"), children[key] == F.col("loser"), "left")
    moved = moved.withColumn("_moved", F.col("loser").isNotNull()).withColumn(key, F.coalesce("survivor", key)).drop("loser", "survivor")
    cols = [c for c in moved.columns if c not in child_key]
    once = moved.groupBy(*child_key).agg(F.min(F.struct("_moved", *[c for c in cols if c != "_moved"])).alias("r"))
    return once.select(*[F.col(c) if c in child_key else F.col(f"r.{c}").alias(c) for c in children.columns])


def cascade_delete(tables: Mapping[str, tuple[DataFrame, str]], ids: DataFrame, id_col: str) -> dict[str, DataFrame]:
    """Every table without the rows of the deleted ids."""
    gone = ids.select(F.col(id_col).alias("_gone"))
    return {name: df.join(gone, df[key] == gone["_gone"], "left_anti") for name, (df, key) in tables.items()}


def enrich(df: DataFrame, key: str, sources: Sequence[tuple[DataFrame, str, Sequence[str]]], shared: DataFrame | None = None) -> DataFrame:
    """Fill what is missing from each source in turn, joined on its key; shared keys are left out."""
    for source, on, fields in sources:
        have = source.select(F.col(on).alias("_on"), *(F.col(f).alias(f"_new_{f}") for f in fields)).groupBy("_on").agg(*(F.min(f"_new_{f}").alias(f"_new_{f}") for f in fields))
        if shared is not None:
            have = have.join(shared.select(F.col(shared.columns[0]).alias("_on")), "_on", "left_anti")
        df = df.join(have, df[key] == have["_on"], "left").drop("_on")
        for f in fields:
            df = df.withColumn(f, F.coalesce(F.col(f), F.col(f"_new_{f}")) if f in df.columns else F.col(f"_new_{f}")).drop(f"_new_{f}")
    return df


def valid_hits(bindings: DataFrame, tasks: DataFrame, observations: DataFrame, task: str, valid: Column, fields: Sequence[str]) -> DataFrame:
    """Distinct valid observations of bound tasks."""
    return bindings.join(tasks, task).join(observations.filter(valid), task).select(*fields).distinct()


def latest_evidence(df: DataFrame, key: str, observations: DataFrame, seq: str, fields: Sequence[str], fallback: Mapping[str, Column]) -> DataFrame:
    """Each entity's latest evidence, or else its own check columns."""
    last = observations.groupBy(key).agg(F.max_by(F.struct(*fields), seq).alias("e"))
    return df.join(last, key, "left").select(*df.columns, F.col("e").isNotNull().alias("observed"), *(F.coalesce(F.col(f"e.{f}"), fallback[f]).alias(f"latest_{f}") for f in fields))
