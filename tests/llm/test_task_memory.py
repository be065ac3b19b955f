"""What an Arrow task holds beside its batch follows a small part of the batch."""

import random
import tracemalloc
from collections import Counter

import pyarrow as pa

from ledgerflow.llm import collocations, substring_dedup


class Task:
    """Stands for a frame and keeps the Arrow task that it is given."""

    def select(self, *_):
        return self

    groupBy = agg = select

    def mapInArrow(self, task, schema):
        self.task = task
        return self


def _most(task, batch, use=lambda out: None):
    tracemalloc.start()
    try:
        for out in task(iter([batch])):
            use(out)
            del out
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_phrases_of_a_large_batch(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)] + ["ö", "ß\x1c", "\x00"]
    rows = [" ".join(rng.choices(words, k=18)) + "\n" + " ".join(rng.choices(words, k=12)) for _ in range(24_000)]
    langs, tails, freqs = ([rng.choice(v) for _ in rows] for v in (("en", "de"), (True, False), (1, 2, 7)))
    batch = pa.RecordBatch.from_pydict({"lang": langs, "chunk": rows, "tail": tails, "freq": pa.array(freqs, pa.int64())})
    want = Counter()
    for lang, row, tail, freq in zip(langs, rows, tails, freqs, strict=True):
        pieces = [p.split(" ") for p in row.split("\n")]
        left = 30 if tail else 28  # the closing window belongs to the next chunk
        for p in pieces:
            for i in range(min(len(p), left)):
                want[lang, ""] += freq
                want[lang, p[i]] += freq
                if i + 1 < len(p):
                    want[lang, f"{p[i]} {p[i + 1]}"] += freq
            left -= len(p)
    found, frame = Counter(), Task()

    def add(out):
        for lang, phrase, f in zip(*(out.column(c).to_pylist() for c in ("lang", "phrase", "f")), strict=True):
            found[lang, phrase] += f

    collocations._counts(frame, (1, 2), 2)
    for out in frame.task(iter([batch])):
        add(out)
    assert found == want
    assert _most(frame.task, batch) < 120  # the whole batch at once took more


def test_anchors_of_a_large_batch(spark):
    rng = random.Random(4)
    text = ["".join(rng.choices("abcdefgh ", k=2000)) for _ in range(2000)]
    frame = Task()
    substring_dedup._grams(frame, 400)
    batch = pa.RecordBatch.from_pydict({"text": text})
    seen = []
    most = _most(frame.task, batch, lambda out: seen.extend(out.column(0).to_pylist()))
    assert most < 50 and len(seen) > 20_000
