"""Filter audits, hard negatives and token counts, by brute force."""

import itertools
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from tickbars.llm import filter_audit, hard_negatives, queries, token_counts
from tickbars.llm.tables import tokenizer_file
from tickbars.llm.textbytes import slices

SF_DIR = "/root/testdata/sf0.001"
WORD_BPE = tokenizer_file("word_bpe_49k.json")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


# --- Filter interaction audit -----------------------------------------------------------

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    """Per row the set of failed filters."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = brute.WORD.findall(text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and doc_id > least[text],
        }
        out.append({k for k, v in failed.items() if v})
    return out


def audits(rows, labels):
    """Document by document, filter by filter."""
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, bad in labels if bad == 1}
    failed = failures(rows)
    out = []
    for part in {lang or "" for _, _, lang in rows}:
        mine = [(i, f) for (i, _, lang), f in zip(rows, failed) if (lang or "") == part]
        steps, total = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, name in enumerate(order):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                total[name] += len(gone)
                steps.append((
                    part, "".join(order), k + 1, name, len(left), len(gone),
                    sum(name in f for _, f in mine) - len(gone),
                    sum(f == {name} for _, f in mine),
                    sum(i in good for i, _ in gone if i is not None),
                    sum(i in toxic for i, _ in gone if i is not None),
                ))
        out += [(*s[:3], *s[4:], total[s[3]]) for s in steps]
    return sorted(out)


def some_documents(seed, n=150):
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.15:
            text = rng.choice([None, "", " \n\x0b", "one", "É$", "ÀB Ω", "a|b"])
        elif kind < 0.3 and rows:
            text = rng.choice(rows)[1]
        else:
            few = names[: rng.choice([20, 300])]
            text = rng.choice([" ", "\t", " \r\n"]).join(rng.choices(few, k=rng.choice([30, 199, 200, 230])))
            text += rng.choice(["", " CAPITALS" * rng.randint(0, 9), " 100%", "é" * 40])
        rows.append((i if rng.random() < 0.95 else None, text, rng.choice(["en", "de", None, ""])))
    return rows + [rows[5], rows[5], (3, rows[7][1], "en")]


@pytest.mark.parametrize("seed, arrow", [(1, "10000"), (2, "7")])
def test_audit_equals_brute_force(spark, seed, arrow):
    rows = some_documents(seed)
    labels = [(i, int(i % 3 == 0), int(i % 5 == 0)) for i in range(0, 150, 2)]
    labels += [(0, 0, 1), (None, 1, 1), (4, None, None), (9999, 1, 1)]
    df = frame(spark, rows, DOCS)
    for name in ("part", "digest", "mask", "good", "toxic", "n", "first", "least"):
        df = df.withColumn(name, F.lit("x"))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, arrow)
    try:
        audit = filter_audit.filter_audit(df, frame(spark, labels, LABELS))
        got = sorted(tuple(r) for r in audit.collect())
    finally:
        spark.conf.set(key, before)
    assert got == audits(rows, labels)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(none, labels).collect() == []
    one = spark.createDataFrame([(None, None, None)], DOCS)
    got = sorted(tuple(r) for r in filter_audit.filter_audit(one, labels).collect())
    assert got == audits([(None, None, None)], [])


def test_masks_do_not_depend_on_slices():
    rows = [(i, t, "") for i, (_, t, _) in enumerate(some_documents(3, 60))]
    rows.append((len(rows), "word Word $ " * 200_000, ""))
    want = [sum(1 << "ABCDE".index(x) for x in f - {"E"}) for f in failures(rows)]
    for limit in (10, 1 << 20):
        got = []
        for _, _, data, offsets in slices(pa.array([t for _, t, _ in rows]), limit):
            got += filter_audit.masks(data, offsets).tolist()
        assert got == want


@pytest.mark.parametrize("n", range(1, 6))
def test_single_swaps_lead_through_all_orders(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for k in filter_audit.plain_changes(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n))))
    assert sum(1 for _ in filter_audit.plain_changes(n)) == len(seen) - 1


def test_swapped_diagrams_keep_their_function():
    """After any swaps a diagram is the one built in that order, with no node more."""
    rng = np.random.default_rng(1)
    for _ in range(20):
        values = rng.integers(0, 3, (16, 3))
        diagram = filter_audit.Diagram(values)
        for k in rng.integers(0, 3, 10):
            diagram.swap(int(k))
            moved = np.zeros_like(values)
            for mask in range(16):
                to = sum(((mask >> v) & 1) << place for place, v in enumerate(diagram.order))
                moved[to] = values[mask]
            built = filter_audit.Diagram(moved)
            assert [len(x) for x in diagram.levels] == [len(x) for x in built.levels]
            for a, b in zip(diagram.passes(), built.passes()):
                assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
        assert (diagram.weight[diagram.root] == values.sum(axis=0)).all()


# --- Hard negatives ----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int"


def mined(rows, every=50, positives=5, negatives=3):
    """All anchors against all rows, in whole numbers."""
    good = [
        (i, [int(np.floor(256 * x)) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for a, (anchor, mine, label) in enumerate(good):
        if anchor % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(mine, v)), i, other)
            for b, (i, v, other) in enumerate(good)
            if a != b and len(v) == len(mine)
        )
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [
                s for s in scored
                if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score
            ]
            out += [
                (anchor, positive, rank, i, -score, -s)
                for rank, (s, i, _) in enumerate(fits[:negatives], 1)
            ]
    return sorted(out)


def some_vectors(seed, n=400, size=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=size) * rng.choice([0.01, 0.5])
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], int(rng.integers(4))))
    return rows


@pytest.mark.parametrize(
    "settings",
    [
        hard_negatives.NegativeSettings(),
        hard_negatives.NegativeSettings(anchor_block=3, row_block=11, pass_bytes=300),
        hard_negatives.NegativeSettings(codes=1, planes=1),
    ],
)
def test_negatives_equal_brute_force(spark, settings):
    rows = some_vectors(1)
    hot = rows[100][1]
    rows += [(400 + k, hot, k % 2) for k in range(150)]
    rows += [(100, hot, 0), (50, rows[50][1], 1), (50, rows[50][1], 1)]
    rows += [(600, None, 1), (650, [0.0] * 8, None), (None, hot, 1), (700, [None] + hot[1:], 1),
             (750, [float("nan")] * 8, 1), (800, [float("inf")] * 8, 1), (850, [0.0] * 8, 1),
             (900, [1.0, 2.0], 1), (901, [2.0, 4.0], 1), (902, [1.5, 2.0], 2), (950, [], 1),
             (951, [], 1), (952, [], 2), (1000, [-x for x in hot], 3)]
    df = frame(spark, rows, VECTORS)
    for name in ("key", "whole", "code", "align", "length", "score", "anchor"):
        df = df.withColumn(name, F.lit("x"))
    got = hard_negatives.hard_negatives(df, settings).collect()
    assert sorted(tuple(r) for r in got) == mined(rows)


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(none).collect() == []
    alone = spark.createDataFrame([(0, [1.0, 0.0], 1), (3, None, None)], VECTORS)
    assert hard_negatives.hard_negatives(alone).collect() == []


@pytest.mark.parametrize("size", [3, 64, 100])
@pytest.mark.parametrize("codes, planes", [(1, 1), (4, 6)])
def test_intervals_hold_all_scores(size, codes, planes):
    rng = np.random.default_rng(size)
    whole = rng.integers(-300, 300, (200, size))
    whole[0], whole[1] = 0, whole[2]
    settings = hard_negatives.NegativeSettings(codes=codes, planes=planes)
    table = pa.table({
        "key": np.arange(40), "label": np.zeros(40, dtype=np.int64),
        "whole": pa.array([x.tobytes() for x in whole[:40]], pa.binary()),
    })
    anchors = hard_negatives.Anchors(table, size, settings)
    code, align = hard_negatives.one_bit_codes(hard_negatives.rotated(whole), codes)
    low, high = anchors.intervals(slice(0, 40), code, align)
    true = whole[:40] @ whole.T
    assert (low <= true).all() and (true <= high).all()
    if codes > 1:
        # Most of the way is taken off the trivial bound.
        lengths = np.linalg.norm(whole, axis=1)
        assert (high - low).mean() < 0.5 * (2 * lengths[:40, None] * lengths).mean()


# --- Token counts ------------------------------------------------------------------------


def whole_counts(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    return [len(x) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_whole_texts(spark):
    rng = random.Random(1)
    alphabet = [*"abzTS019 '’\n\t.,!<|>éßστΣİ漢字　́ᲀ\x85\xa0½²'stvremld", "\x1c"]
    alphabet += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'re", "'ll", " word", "W0rd"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", "long" * 40_000, "aB3dE/" * 30_000, "one two " * 60_000, "́a" * 500]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (7, texts[7]), (8, None)]
    df = frame(spark, rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    want = whole_counts([t or "" for _, t in rows])
    got = token_counts.token_counts(df, WORD_BPE, limit=9).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(
        str((i, len((t or "").encode()), n, n > 9)) for (i, t), n in zip(rows, want)
    )


def test_counts_are_remembered_within_bounds(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 5)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 10)
    counter = token_counts.LengthCounter(WORD_BPE)
    texts = [f"word{i % 13} and number {i}" for i in range(60)]
    got = []
    for _, _, data, offsets in slices(pa.array(texts), 50):
        got += counter.counts(data, offsets).tolist()
        assert len(counter._known) <= 5 + 200 and len(counter._before) <= 5 + 200
    assert got == whole_counts(texts)


def test_counts_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert token_counts.token_counts(none, WORD_BPE).collect() == []


def test_registered_counts_of_whole_documents(spark):
    rows = duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF_DIR}/documents.parquet'").fetchall()
    got = queries.op13_token_counts(spark, SF_DIR).collect()
    want = whole_counts([t for _, t in rows])
    assert sorted(tuple(r) for r in got) == sorted(
        (i, len(t.encode()), n, n > 2048) for (i, t), n in zip(rows, want)
    )
