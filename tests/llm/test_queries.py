"""The registered queries on the smallest tables, against DuckDB where it can say them; and the pipeline's stages."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from claimgraph.llm.common import cut
from claimgraph.llm.queries import ORACLES, QUERIES, tokenizer_path
from claimgraph.llm.secrets import scanner

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name]).fetchall()
    names = [x[0] for x in con.description]
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, want))


def test_all_are_registered():
    found = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {x[: x.index("_") + 1] for x in found if x.startswith("op")} and "pipeline" in found


def representatives(rows):
    """Smallest doc_id of each group of linked documents, by comparing all pairs."""
    lower = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for r in rows:
        w = (r["text"] or "").translate(lower).encode().split()
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def test_stages_keep_rows_of_any_shape(spark):
    """Empty tables, null ids and texts, repeated rows and columns named like internal ones go through every stage."""
    schema = "doc_id long, text string, source string, lang string, n_chars long, score string, copies int, kept boolean, label int, row string"
    story = " ".join(f"word{i}" for i in range(30))
    rows = [(i, f"{story} {i}" if i < 4 else f"text {i} of its own" + " pad" * i, "ab"[i % 2], "en", 9, "s", 5, False, 3, "r") for i in range(20)]
    rows += [(7, "another text of seven", "a", "en", 9, "s", 5, False, 3, "r")] * 2 + [(None, "no id", "a", "en", 9, "s", 5, False, 3, "r"), (None, None, None, None, None, None, None, None, None, None), (30, "", "b", "en", 0, "s", 5, True, 3, "r")]
    for own in (rows, []):
        docs = spark.createDataFrame(own, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = cut(stage(spark, docs, SF))
            assert after.schema.simpleString() == docs.schema.simpleString(), name
            if own:
                assert {(r["score"], r["copies"], r["label"]) for r in after.collect()} <= {("s", 5, 3), (None, None, None)}
                assert after.filter("doc_id is null and text = 'no id'").count() >= (1 if name != "mixing" else 0)
            docs = after
        assert bool(corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()) == bool(own)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns and 0.7 * n < kept.count() < n
    kept = cut(kept)
    fewer = cut(corpus_pipeline.drop_near_duplicates(spark, kept, SF))
    assert fewer.columns == docs.columns and {r["doc_id"] for r in fewer.collect()} == representatives(kept.collect())
    masked = cut(corpus_pipeline.mask_secrets(spark, fewer, SF))
    before, after = ({r["doc_id"]: r for r in df.collect()} for df in (fewer, masked))
    scan = scanner()
    assert masked.columns == docs.columns and before.keys() == after.keys()
    for i, r in before.items():
        assert (r["text"] == after[i]["text"]) == (not scan(r["text"] or "")) and after[i]["n_chars"] == len(after[i]["text"])
    mixed = cut(corpus_pipeline.mix_sources(spark, masked, SF))
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert all(r == after[r["doc_id"]] for r in rows) and max(Counter(r["doc_id"] for r in rows).values()) <= 3
    slow = Tokenizer.from_file(tokenizer_path())
    pieces = corpus_pipeline.pack_tokens(spark, mixed, SF).collect()
    tokens = Counter()
    for r in pieces:
        tokens[r["doc_id"]] += r["length"]
        assert r["length"] <= 1024
        ids = slow.encode(after[r["doc_id"]]["text"], add_special_tokens=False).ids + [0]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    assert tokens == sum((Counter({r["doc_id"]: r["doc_tokens"]}) for r in pieces if r["start"] == 0), Counter())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]
