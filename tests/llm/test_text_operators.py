"""Repeats, near copies, benchmark passages and language-model scores, by brute force."""

import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from tickbars.llm import near_text, repeats
from tickbars.llm.components import components
from tickbars.llm.decontaminate import contamination, keep_uncontaminated
from tickbars.llm.lattice_lm import Lattice, _bag_sums, _packed, _unpacked, score_documents
from tickbars.llm.near_text import keep_first, near_components
from tickbars.llm.shingles import SketchSettings
from tickbars.llm.tables import store, tokenizer_file
from tickbars.llm.textbytes import ALPHANUMERIC, NOT_SPACE, sliding_min, slices, words

TEXT = "doc_id long, text string"


def frame(spark, rows, schema=TEXT):
    return spark.createDataFrame(rows, schema).repartition(3)


def vocabulary(rng, n=60):
    return ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n)]


def clashing(df):
    """``df`` with columns of the names that the operators use inside."""
    names = ["tie", "row_key", "class", "component", "kept", "n_words", "spans", "size", "place"]
    return df.select("*", *[F.lit("x").alias(c) for c in names])


def made_up(seed, n=60):
    """Copies, near copies, shared passages, blanks and repeated words."""
    rng = random.Random(seed)
    names = vocabulary(rng)
    passages = [" ".join(rng.choices(names, k=rng.randint(20, 60))) for _ in range(4)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.1:
            text = rng.choice([None, "", " \n ", "one", "a b"])
        elif kind < 0.5 and rows:
            text = rng.choice(rows)[1] or ""
            w = text.split(" ")
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(names).upper()
            text = " ".join(w)
        else:
            text = " ".join(rng.choices(names, k=rng.randint(1, 60)))
            if rng.random() < 0.5:
                text += "\n" + rng.choice(passages)
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("limit", [15, 1 << 20])
@pytest.mark.parametrize("kind, pattern", [(NOT_SPACE, brute.WORD), (ALPHANUMERIC, brute.ALNUM)])
def test_words_of_bytes(limit, kind, pattern):
    rng = random.Random(1)
    for _ in range(40):
        texts = ["".join(rng.choice("ab Z\n\tÄ,") for _ in range(rng.randint(0, 9))) for _ in range(7)]
        texts.append(None)
        for low, high, data, offsets in slices(pa.array(texts), limit):
            found = words(data, offsets, kind)
            got = [(r, bytes(data[a:b]).decode()) for r, a, b in zip(found.row, found.start, found.end)]
            want = [(i, w) for i in range(high - low) for w in pattern.findall(
                (texts[low + i] or "") if kind is NOT_SPACE else brute_upper(texts[low + i]))]
            assert [r for r, _ in got] == [r for r, _ in want]
            names = {}
            for (_, w), h in zip(got, found.hash):
                assert names.setdefault(w.translate(brute.LOWER), h) == h
            assert len(set(names.values())) == len(names)


def brute_upper(text):
    """Upper-case letters are word bytes before lower-casing, too."""
    return (text or "").translate(brute.LOWER)


def test_sliding_minimum():
    values = np.random.default_rng(1).integers(0, 99, 300).astype(np.uint64)
    for width in (1, 2, 7, 53, 300, 301):
        want = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert sliding_min(values, width).tolist() == want


# --- Repeats ---------------------------------------------------------------------------


def removed(df):
    return sorted((tuple(r) for r in repeats.remove_repeats(df).collect()), key=str)


@pytest.mark.parametrize("seed, arrow", [(1, "10000"), (2, "3")])
def test_repeats_equal_brute_force(spark, seed, arrow):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(30, 400))) for _ in range(5)]
    rows = []
    for i in range(50):
        parts = [rng.choice(base)[rng.randint(0, 50) : rng.randint(60, 400)] for _ in range(rng.randint(0, 4))]
        text = "".join(parts) if rng.random() < 0.8 else rng.choice(["ab", "a"]) * rng.randint(40, 200)
        rows.append((i, text if rng.random() > 0.1 else None))
    rows += [(None, base[0] * 2), (7, rows[7][1]), (7, rows[7][1])]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, arrow)
    try:
        assert removed(clashing(frame(spark, rows))) == sorted(brute.repeats(rows), key=str)
    finally:
        spark.conf.set(key, before)


def test_repeats_in_pieces_of_long_texts(spark, monkeypatch):
    rng = random.Random(5)
    once = "".join(rng.choice("abcdefgh") for _ in range(700))
    rows = [(1, once + once[50:400] + "x" * 300), (2, "y" + once[100:260]), (3, "")]
    for low, data, offsets, place in repeats.pieces(pa.array([t for _, t in rows]), 100):
        assert place == 0
    monkeypatch.setattr(repeats, "PIECE", 128)
    found = [(low, place, len(d)) for low, d, _, place in repeats.pieces(pa.array([rows[0][1]]), 100)]
    assert len(found) > 5 and all(size <= 227 for _, _, size in found)
    assert removed(frame(spark, rows)) == sorted(brute.repeats(rows), key=str)


def test_repeats_of_nothing(spark):
    assert removed(frame(spark, [])) == []


# --- Near copies -----------------------------------------------------------------------


@pytest.mark.parametrize("seed, limit", [(1, 20_000), (2, 3)])
def test_near_copies_equal_brute_force(spark, seed, limit):
    rows = made_up(seed, 90)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "4")
    try:
        found = near_components(clashing(frame(spark, rows)), bucket_limit=limit).collect()
    finally:
        spark.conf.set(key, before)
    want = brute.near(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_a_family_around_the_limit(spark):
    """Copies with a tenth of the words changed are linked to some of each other only."""
    rng = random.Random(9)
    names = vocabulary(rng, 4000)
    base = rng.sample(names, 200) if len(set(names)) >= 200 else names
    rows = []
    for i in range(80):
        w = list(base)
        for k in rng.sample(range(200), rng.randint(0, 14)):
            w[k] = f"{rng.choice(names)}{i}"
        rows.append((i, " ".join(w)))
    found = {r.doc_id: r.component_id for r in near_components(frame(spark, rows)).collect()}
    assert found == {i: c for i, (_, c) in brute.near(rows).items()}


def copies(seed, n, most, size=200):
    """Copies of one text with up to ``most`` of its words changed, in order of ids."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(size)]
    rows = []
    for i in range(n):
        w = list(base)
        for k in rng.sample(range(size), rng.randint(0, most)):
            w[k] = f"x{i}y{k}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("most, limit", [(8, 5), (24, 5), (24, 20)])
def test_buckets_beyond_the_limit_lose_no_link(spark, most, limit):
    """Two bands of one sample: most pairs meet in one band only."""
    rows = copies(3, 70, most)
    settings = SketchSettings(bands=2, rows=1)
    whole = near_components(frame(spark, rows), settings).collect()
    found = near_components(frame(spark, rows), settings, bucket_limit=limit).collect()
    assert {r.doc_id: r.component_id for r in found} == {r.doc_id: r.component_id for r in whole}


def test_groups_of_large_buckets_are_bounded(spark):
    rows = [(k, [5, 6, 7 + k % 2]) for k in range(1200)]
    classes = spark.createDataFrame(rows, "class long, bands array<long>")
    members, hot = near_text._buckets(classes, 100)
    apart = spark.createDataFrame([(k, k // 400) for k in range(1200)], "id long, component long")
    rest = near_text._rest(hot, apart, 100)
    for groups in (members, rest):
        assert groups.groupBy("bucket").count().agg(F.max("count")).first()[0] < 160
    assert members.count() == 2 * hot.count()
    # Every two members of a bucket in different components meet.
    met = rest.toDF("bucket", "a").join(rest.toDF("bucket", "b"), "bucket").where("a < b")
    assert met.where("a div 400 <> b div 400").select("a", "b").distinct().count() == 3 * 400 * 400
    one = apart.withColumn("component", F.lit(0))
    assert near_text._rest(hot, one, 100).count() == 0


def test_full_sets_are_moved_by_row_and_by_family_alone(spark, monkeypatch):
    """Broadcast joins hide further moves on small tables; here there are none."""
    plans = {}

    def noted(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, purpose)

    monkeypatch.setattr(near_text, "store", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = made_up(6, 60)
        rows += [(900, rows[0][1]), (900, rows[0][1])]
        near_components(frame(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for purpose, key in (("near-sets", "row_key"), ("near-components", "component")):
        moved = re.findall(r"Exchange hashpartitioning\((\w+?)#", plans[purpose])
        assert moved and set(moved) == {key}


def test_near_copies_without_ids_and_with_equal_ids(spark):
    text = "a b c d e f g h i j"
    rows = [(None, text), (5, text), (5, text + " k"), (5, "x y z"), (None, None), (8, " ")]
    found = near_components(frame(spark, rows)).collect()
    assert sorted((r.n_shingles, r.component_id) for r in found if r.n_shingles) == [
        (2, 5), (9, 5), (9, 5), (10, 5)
    ]
    assert sorted((r.doc_id, r.component_id) for r in found if not r.n_shingles and r.doc_id) == [(8, 8)]
    kept = keep_first(clashing(frame(spark, rows)))
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == ["5", "5", "8", "None"]


def test_near_copies_of_nothing(spark):
    assert near_components(frame(spark, [])).count() == 0
    assert keep_first(frame(spark, [])).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (3, 2)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}}


def test_sketches_keep_linked_pairs():
    assert SketchSettings().most_bits < 256
    assert near_text.BUCKET_LIMIT > 1000


# --- Benchmark passages ----------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    names = vocabulary(rng, 12)
    items = [(k, " ".join(rng.choices(names, k=rng.randint(0, 40)))) for k in range(12)]
    items += [(12, None), (13, "!!"), (3, items[3][1]), (None, " ".join(rng.choices(names, k=20)))]
    rows = [(i, t) for i, t in made_up(seed)]
    for i in range(60, 100):
        text = " ".join(rng.choices(names, k=rng.randint(0, 300)))
        item = rng.choice(items)[1] or ""
        cut = item.split()[rng.randint(0, 5) :]
        rows.append((i, text + "," + " - ".join(cut).upper() if rng.random() < 0.7 else text))
    df = clashing(frame(spark, rows))
    found = contamination(df, frame(spark, items, "item_id long, text string")).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found}
    want = brute.contaminated(rows, items)
    assert got == want
    kept = keep_uncontaminated(df, frame(spark, items, "item_id long, text string"))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, x in sorted(want.items()) if not x[4]]


def test_contamination_without_a_benchmark_or_documents(spark):
    none = frame(spark, [], "item_id long, text string")
    [row] = contamination(frame(spark, [(1, "a b")]), none).collect()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    some = frame(spark, [(1, "a b")], "item_id long, text string")
    assert contamination(frame(spark, []), some).count() == 0


# --- Language model --------------------------------------------------------------------


def test_lattice_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "<0xC3>", "<0xA9>", "ba"]
    scores = np.log(np.array([0.2, 0.1, 0.1, 0.05, 0.1, 0.05, 0.02, 0.03, 0.04]))
    p = dict(zip(pieces, np.exp(scores)))

    def total(text):
        if not text:
            return 1.0
        out = sum(p[x] * total(text[len(x) :]) for x in pieces if text.startswith(x))
        if text[0] not in p:
            out += math.prod(p[f"<0x{b:02X}>"] for b in text[0].encode()) * total(text[1:])
        return out

    lattice = Lattice(pieces, scores)
    for word in ("ab", "abab", "aé", "bbba", "é"):
        assert lattice.word(word) == pytest.approx(math.log10(total("▁" + word)))
    # Far beyond what a product of probabilities could hold.
    assert lattice.word("ab" * 4000) < -2000


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(2)
    bounds = np.array([0, 0, 5, 5, 400, 401])
    numbers = rng.integers(0, 1 << 30, 401)
    numbers[:5] = [3, 3, 3, 0, 127]
    packed = _packed(numbers, bounds)
    data = np.frombuffer(b"".join(packed), dtype=np.uint8)
    row, got = _unpacked(data, np.repeat(np.arange(5), [len(x) for x in packed]))
    want = [(r, x) for r in range(5) for x in sorted(numbers[bounds[r] : bounds[r + 1]])]
    assert list(zip(row.tolist(), got.tolist())) == want


def test_a_slices_bags_take_little_memory():
    """A worker holds the numbers of a slice, not several wide arrays beside them."""
    rng = np.random.default_rng(3)
    bounds = np.append(0, np.cumsum(rng.integers(0, 900, 4000)))
    numbers = rng.integers(0, 200_000, bounds[-1]).astype(np.int32)
    value = rng.random(200_000)
    tracemalloc.start()
    packed = _packed(numbers, bounds)
    held = sum(map(len, packed))
    assert tracemalloc.get_traced_memory()[1] < 8 * held
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    total, known = _bag_sums(packed, (value, value > 0.5))
    assert tracemalloc.get_traced_memory()[1] - before < 8 * held
    tracemalloc.stop()
    row = np.repeat(np.arange(4000), np.diff(bounds))
    assert total == pytest.approx(np.bincount(row, value[numbers], minlength=4000))
    assert known.tolist() == np.bincount(row, value[numbers] > 0.5, minlength=4000).tolist()


def test_scores_of_documents(spark):
    rows = made_up(4, 60)
    path = tokenizer_file("piece_bpe_32k.model")
    found = {r.doc_id: r for r in score_documents(clashing(frame(spark, rows)), path).collect()}
    want = brute.base_scores(rows)
    assert set(found) == set(want)
    for i, (held, tokens, known, train, base) in want.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, train)
        assert r.base_score == pytest.approx(base) and -1e6 < r.score < 0
    more = [*rows, (900, rows[3][1]), (None, "new words"), (None, None)]
    again = score_documents(frame(spark, more), path).collect()
    assert len(again) == len(more) and sum(r.doc_id is None and not r.held_out for r in again) == 2
    assert score_documents(frame(spark, []), path).count() == 0
