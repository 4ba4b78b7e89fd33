"""Hierarchical multi-length packing of tokenised documents.

Each task tokenises its documents and packs them in shards of a few million tokens. A document fills whole windows of
the largest tier; its rest is routed to the smallest tier that holds it. From the largest tier down, every rest opens a
window of its tier, and the gap behind it is filled exactly, by cutting, from rests of shorter tiers, shortest first;
when those run out, the shortest rests of the tier itself are cut up as filling. So one window of a shard at most has
room left. Windows of a tier are dealt to step groups of equal token budgets.

No row moves between tasks and nothing is gathered: the plan is one pass over the input, whatever the sizes or sources,
and a task that runs again gives the same rows. Memory is bounded by one shard and one document.

Defined cases: null text is empty, and an empty text is one piece, its end token; equal texts and repeated rows are
packed each; an empty table gives no rows; a null doc_id stays null; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (1024, 512, 256)
SHARD_TOKENS = 1 << 22
STEP_WINDOWS = 8
#: The splitting pattern of byte-level BPE, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranks(model: dict) -> dict[bytes, int] | None:
    """Byte strings and ids of a byte-level BPE vocabulary whose ids follow the order of its merges, else None."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow 256
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    vocab = model["vocab"]
    merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "", 1)) for m in model["merges"]]
    if any(x not in byte for token in vocab for x in token if token in vocab and vocab[token] < 256) or merged != sorted(merged, key=lambda i: -1 if i is None else i):
        return None
    return {bytes(byte[x] for x in token): i for token, i in vocab.items() if all(x in byte for x in token)}


@functools.lru_cache(maxsize=2)
def text_encoder(path: str) -> Callable[[str], bytes]:
    """Ids of a whole text, as little-endian unsigned 32-bit numbers, for a file of the ``tokenizers`` library.

    A byte-level BPE file is run by ``tiktoken``, four times as fast with the same ids; texts that hold one of the file's
    added tokens, and files of any other kind, go through ``tokenizers``.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    spec, slow = json.loads(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    before = spec.get("pre_tokenizer") or {}
    usual = spec["model"]["type"] == "BPE" and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and not spec.get("normalizer")
    ranks = _ranks(spec["model"]) if usual else None
    added = [x["content"] for x in spec.get("added_tokens", [])]
    if ranks is None:
        return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    import tiktoken

    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={k: v for k, v in ranks.items() if k.decode("utf-8", "replace") not in added}, special_tokens={})
    encode = fast._core_bpe.encode_ordinary if hasattr(fast, "_core_bpe") else fast.encode_ordinary

    def ids(text: str) -> bytes:
        if any(x in text for x in added):
            return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(encode(text), "<u4").tobytes() if sys.byteorder != "little" else array("I", encode(text)).tobytes()

    return ids


def pack_plan(lengths: np.ndarray, tiers: tuple[int, ...] = TIERS) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (document, start, length, window, offset) and the tier of each window."""
    top = tiers[0]
    pieces, kinds, count = [], [], 0
    whole = lengths // top
    doc = np.repeat(np.arange(len(lengths)), whole)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    pieces.append(np.stack((doc, nth * top, np.full(len(doc), top), np.arange(len(doc)), np.zeros(len(doc), np.int64)), 1))
    kinds.append(np.full(len(doc), top))
    count = len(doc)
    rest = lengths % top
    left = np.flatnonzero(rest)
    left = left[np.argsort(-rest[left], kind="stable")]  # longest first
    begin = (whole * top)[left]
    size = rest[left]
    for k, tier in enumerate(tiers):
        if not len(left):
            break
        here = int((size > tiers[k + 1]).sum()) if k + 1 < len(tiers) else 0
        gaps, fill = int((tier - size[:here]).sum()), int(size[here:].sum())
        last = k + 1 == len(tiers) or gaps > fill
        heads = int(size.sum()) // tier if last else here
        if heads:
            pieces.append(np.stack((left[:heads], begin[:heads], size[:heads], count + np.arange(heads), np.zeros(heads, np.int64)), 1))
            kinds.append(np.full(heads, tier))
        # the shortest rests fill the gaps in a row, cut where a gap ends
        l, b, s = left[heads:][::-1], begin[heads:][::-1], size[heads:][::-1]  # noqa: E741
        room = np.concatenate(([0], np.cumsum(tier - size[:heads])))
        run = np.concatenate(([0], np.cumsum(s)))
        end = int(room[-1])
        edges = np.unique(np.concatenate((room, run[run <= end])))
        a, length = edges[:-1], np.diff(edges)
        i, j = np.searchsorted(run, a, "right") - 1, np.searchsorted(room, a, "right") - 1
        if len(a):
            pieces.append(np.stack((l[i], b[i] + a - run[i], length, count + j, size[:heads][j] + a - room[j]), 1))
        count += heads
        if end >= run[-1]:
            break
        i = int(np.searchsorted(run, end, "right")) - 1  # what is left over
        l, b, s = l[i:], b[i:].copy(), s[i:].copy()  # noqa: E741
        b[0] += end - run[i]
        s[0] -= end - run[i]
        if last:  # less than a window: one more
            pieces.append(np.stack((l, b, s, np.full(len(s), count), np.cumsum(s) - s), 1))
            kinds.append(np.full(1, min(t for t in tiers if t >= s.sum())))
            break
        order = np.argsort(-s, kind="stable")
        left, begin, size = l[order], b[order], s[order]
    return np.concatenate(pieces).astype(np.int64), np.concatenate(kinds) if kinds else np.empty(0, np.int64)


def pack(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of packed sequences.

    Returns doc_id, start, length, doc_tokens, sequence_id, offset, tier, step_group and token_ids (binary: little-endian
    unsigned 32-bit ids of the piece). Each document is followed by ``end_id``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base = text_encoder(tokenizer_path), TaskContext.get().partitionId() << 36
        stop = np.array([end_id], "<u4").tobytes()
        ids: list = []
        held: list[bytes] = []
        tokens = sequences = groups = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal tokens, sequences, groups
            if not held:
                return
            n = np.array([len(x) // 4 for x in held], np.int64)
            pieces, kinds = pack_plan(n, tiers)
            step = np.empty(len(kinds), np.int64)
            for tier in tiers:
                own = np.flatnonzero(kinds == tier)
                step[own] = groups + np.arange(len(own)) // (STEP_WINDOWS * tiers[0] // tier)
                groups += -(-len(own) // (STEP_WINDOWS * tiers[0] // tier))
            for i in range(0, len(pieces), 2000):
                p = pieces[i : i + 2000]
                raw = [held[d][4 * s : 4 * (s + k)] for d, s, k in p[:, :3].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[d] for d in p[:, 0].tolist()], pa.int64()), *(pa.array(x) for x in (p[:, 1], p[:, 2], n[p[:, 0]], base + sequences + p[:, 3], p[:, 4], kinds[p[:, 3]], base + step[p[:, 3]])), pa.array(raw, pa.binary())],
                    names=names,
                )
            sequences += len(kinds)
            ids.clear()
            held.clear()
            tokens = 0

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, text in zip(keys, texts, strict=True):
                raw = encode(text or "")
                ids.append(key)
                held.append(raw + stop)
                tokens += len(raw) // 4 + 1
                if tokens >= SHARD_TOKENS:
                    yield from flush()
        yield from flush()

    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "token_ids"]
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, ", ".join(f"{n} {'binary' if n == 'token_ids' else 'long'}" for n in names))
