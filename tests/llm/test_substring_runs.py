"""Shared passages against brute force over all runs of sentences, not only the shortest from each."""

import numpy as np
import pyarrow as pa

from tests.llm.helpers import documents
from tickerloom.llm import substring_dedup
from tickerloom.llm.substring_dedup import RUN, WORDS


def gone_of(texts):
    """The sentences of each text that any run covers which stands earlier, too."""
    seen, gone = set(), [set() for _ in texts]
    for i, text in enumerate(texts):
        _, numbers, words = substring_dedup.sentences(text.encode())
        keys = [b" ".join(w) for w in words]
        for first in range(len(keys)):
            for last in range(first + RUN, len(keys) + 1):
                if sum(numbers[first:last]) >= WORDS:
                    key = tuple(keys[first:last])
                    if key in seen:
                        gone[i].update(range(first, last))
                    seen.add(key)
    return gone


def removed_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = substring_dedup.deduplicated(docs).select("row.doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in found}


def left_of(text, gone):
    data, ends = text.encode(), substring_dedup.sentences(text.encode())[0]
    return b"".join(data[a:b] for k, (a, b) in enumerate(zip([0, *ends], ends)) if k not in gone).decode()


def test_every_run(spark):
    random = np.random.default_rng(5)
    pool = [" ".join(f"w{random.integers(400)}" for _ in range(n)) + ". " for n in random.integers(1, 12, 60)]
    texts = []
    for _ in range(40):
        parts = [pool[random.integers(60)] for _ in range(4)]
        for _ in range(3):
            at = random.integers(0, 50)
            parts += [*pool[at:at + random.integers(3, 9)], pool[random.integers(60)]]
        texts.append("".join(parts))
    texts += [t for t in documents().text if 0 < len(t) < 2_000][:60]
    found, want = removed_of(spark, texts), gone_of(texts)
    assert {i: left_of(t, want[i]) for i, t in enumerate(texts)} == found


def test_end_of_a_passage(spark):
    """The last sentences are in no shortest run that begins inside the passage."""
    lengths = (10, 10, 10, 2, 1)
    passage = " ".join(" ".join(f"p{k}x{i}" for i in range(n)) + "." for k, n in enumerate(lengths))
    found = removed_of(spark, [f"Start {i}. {passage} After {i} come other words. And {i} more." for i in range(3)])
    assert all("p4x0" not in found[i] and "p0x0" not in found[i] and "After" in found[i] for i in (1, 2))


def test_unmarked_passages_of_over_50_words(spark):
    """Words that one checksum alone would never part; 51 of them between different words."""
    random = np.random.default_rng(6)
    for _ in range(200):
        words = [b"v%d" % i for i in random.integers(0, 10_000, 51)]
        shared = []
        for _ in range(2):
            around = [[b"a%d" % i for i in random.integers(0, 10_000, random.integers(0, 30))] for _ in range(2)]
            _, numbers, texts = substring_dedup.sentences(b" ".join([*around[0], *words, *around[1]]))
            first, ends = substring_dedup.all_spans(numbers)
            _, h1, h2 = substring_dedup.span_hashes(texts, ends, first)
            assert max(numbers) <= max(substring_dedup.LONG, substring_dedup.NEAR)
            shared.append(set(zip(h1.tolist(), h2.tolist())))
        assert shared[0] & shared[1]


def test_texts_of_a_batch_as_each_alone():
    """Sentences are numbered through a batch: parts, spans and hashes are those of each text by itself."""
    texts = [t for t in documents().text if len(t) < 4_000][:80] + [None, "", "\n", " a b", "w " * 100, "No. Run. Here."]
    batch = pa.RecordBatch.from_pydict({"rid": range(len(texts)), "doc_id": range(len(texts)), "text": pa.array(texts, pa.string())})
    found = pa.Table.from_batches(substring_dedup._hashed(iter([batch, batch.slice(0, 0)]))).to_pydict()
    want, counts, whole = [], [], []
    for row, text in enumerate(texts):
        _, numbers, words = substring_dedup.sentences((text or "").encode())
        counts.append(len(numbers))
        whole += numbers
        if numbers:
            first, ends = substring_dedup.all_spans(numbers)
            _, h1, h2 = substring_dedup.span_hashes(words, ends, first)
            want += zip([row] * len(first), (first << 32 | ends - first).tolist(), h1.tolist(), h2.tolist())
    assert sorted(zip(*[found[c] for c in ("rid", "place", "h1", "h2")])) == sorted(want) and len(want) > 500
    assert len(substring_dedup.all_spans(whole, counts)[0]) == len(want)
