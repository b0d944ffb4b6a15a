"""Vectors, token files, mixing, URL rules, personal data, quality and the pipeline."""

import hashlib
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from tickbars.llm import mixing, pii, queries, url_rules
from tickbars.llm.hnsw import Graph, GraphSettings
from tickbars.llm.decontaminate import keep_uncontaminated
from tickbars.llm.near_text import keep_first
from tickbars.llm.near_vectors import (
    VectorSettings,
    _found,
    audited_beam,
    vector_components,
)
from tickbars.llm.quality import (
    QualitySettings,
    _features,
    _rated,
    _telling,
    fit_ordinal,
    fit_quality,
    grade_documents,
    hashed_features,
    keep_good,
)
from tickbars.llm.tables import tokenizer_file
from tickbars.llm.tokens import ChunkEncoder, read_tokens, token_digest, write_tokens
from tickbars.llm.textbytes import slices

SF_DIR = "/root/testdata/sf0.001"
BPE = tokenizer_file("byte_bpe_50k.json")


# --- Vectors ---------------------------------------------------------------------------


def linked(rows, cosine=0.9):
    good = {
        k: np.array(v, dtype=float)
        for k, (_, v) in enumerate(rows)
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    links = [
        (a, b)
        for a in good
        for b in good
        if a < b and len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= cosine
    ]
    found = brute.groups(range(len(rows)), links)
    count = {k: sum(k in x for x in links) for k in range(len(rows))}
    return [(i, count[k], rows[found[k]][0], found[k] == k) for k, (i, _) in enumerate(rows)]


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        v = rng.normal(size=8)
        if i % 5 == 0 and rows:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(size=8) * 0.1
        rows.append((i, [float(x) for x in v]))
    hot = rows[3][1]
    rows += [(400 + k, hot) for k in range(50)]
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [None] + [1.0] * 7),
             (504, [float("nan")] * 8), (505, [float("inf")] + [1.0] * 7), (506, [1.0, 2.0]),
             (507, [2.0, 4.0]), (508, [x * 1e100 for x in hot])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    df = df.select("*", F.lit(1).alias("class"), F.lit(2).alias("weight"))
    got = vector_components(df, VectorSettings(shards=3, block=100, audit=400)).collect()
    assert sorted(tuple(r) for r in got) == linked(rows)


def test_audits_say_something_where_links_are_few():
    """A thousand queries of which none that the task compares has a link."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(4000, 24))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    near = rows[:1000] + rng.normal(size=(1000, 24)) * 0.05
    near[::10] = rng.normal(size=(100, 24))
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    settings = VectorSettings(audit=96)
    graph = Graph(rows, settings.graph)
    assert audited_beam(graph, rows, settings) <= settings.widest
    like = near @ rows.T
    want = set(zip(*(x.tolist() for x in np.nonzero(like >= settings.cosine))))
    have = set(zip(*(x.tolist() for x in _found(graph, rows, near, settings))))
    assert have <= want and len(have) >= 0.99 * len(want) > 800
    # A graph that finds nothing, which made-up links tell.
    class Blind:
        vectors = graph.vectors

        def search(self, queries, beam):
            return np.full((len(queries), beam), -1), np.full((len(queries), beam), -1.0)

    assert audited_beam(Blind(), rows, settings) > settings.widest
    assert set(zip(*(x.tolist() for x in _found(Blind(), rows, near, settings)))) == want
    one = np.ones((5, 1))
    assert audited_beam(Graph(one, settings.graph), one, settings) == settings.beam


def test_a_larger_graph_asks_for_no_wider_beam():
    """Beams that grow with a graph make a search cost more than its share of the rows."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(400, 64))
    rows = centres[rng.integers(400, size=8000)] + rng.normal(size=(8000, 64)) * 1.5
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    settings = VectorSettings()
    for n in (1600, 8000):
        graph = Graph(rows[:n], settings.graph)
        assert audited_beam(graph, rows[:n], settings) == settings.beam
    deep = Graph(rows, GraphSettings(top=600))
    assert len(deep.sizes) == 3
    assert audited_beam(deep, rows, settings) <= 2 * settings.beam


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_components(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), (1, None)], empty.schema)
    assert sorted(str(tuple(r)) for r in vector_components(nulls).collect()) == [
        "(1, 0, 1, True)", "(None, 0, None, True)"
    ]


def test_a_graph_finds_what_is_near():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(3000, 32))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    near = rows[:500] + rng.normal(size=(500, 32)) * 0.03
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    found, like = Graph(rows).search(near, 32)
    true = (near @ rows.T).argmax(axis=1)
    assert np.mean([t in f for t, f in zip(true, found)]) > 0.97
    assert (np.diff(like, axis=1) <= 0).all()


# --- Token files -----------------------------------------------------------------------

def test_a_remembered_chunk_takes_few_bytes():
    """So that a worker can remember most chunks of a large table."""
    encoder = ChunkEncoder(tokenizer_file("byte_bpe_50k.json"))

    def ids(seed):
        text = " ".join(f"{x:x}" for x in np.random.default_rng(seed).integers(1 << 31, size=9000))
        _, _, data, offsets = next(slices(pa.array([text])))
        return encoder.ids(data, offsets)[0]

    ids(0)
    tracemalloc.start()
    many = [ids(k) for k in range(1, 13)]
    held = tracemalloc.get_traced_memory()[0] - sum(x.nbytes for x in many)
    tracemalloc.stop()
    assert held < 12 * 9000 * 72
    assert all((ids(k) == many[k - 1]).all() for k in range(1, 13))



def test_chunks_encode_as_the_whole_text():
    from tokenizers import Tokenizer

    plain, encoder = Tokenizer.from_file(BPE), ChunkEncoder(BPE)
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", " \n", "'s", "1", "é", ".", "\x1c", "　", "\xa0", "日本",
             "\t", " don't", "😀", "×", "\u2009", "\u0085", "<|endoftext|>", "\n\n", ",", "-",
             "!?", "<|", "|>", "_", "'", "A", "1.5"]
    for _ in range(800):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(5)] + [None]
        for low, high, data, offsets in slices(pa.array(texts, pa.string()), 40):
            ids, counts = encoder.ids(data, offsets)
            want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts[low:high]]
            assert counts.tolist() == [len(w) for w in want]
            assert ids.tolist() == sum(want, [])


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["ab", "cd,", "Ef"], k=i % 50))) for i in range(300)]
    rows += [(None, None), (17, "again"), (17, "again"), (400, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = str(tmp_path / "tokens")
    write_tokens(df.withColumn("ids", F.lit(0)).withColumn("shard", F.lit("x")), path, BPE)
    read = read_tokens(spark, path)
    got = sorted(read.collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids[-1]) == (at, len(r.ids), 2)
        at += r.n_tokens
    texts = {i: t for i, t in rows if i != 17}
    for r in got:
        if r.doc_id in texts:
            assert r.ids == plain.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
    for r in token_digest(read).collect():
        [same] = [g for g in got if g.start == r.start]
        assert r.ids_crc32 == zlib.crc32(np.array(same.ids, "<u4").tobytes())
    # Dictionaries for ids, deltas for numbers, and indexes for pages.
    [file, *_] = [p for p in (tmp_path / "tokens").glob("*.parquet")]
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["place"].encodings
    assert columns["doc_id"].has_offset_index
    plan = read.filter("doc_id = 5").select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,5)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_no_token_files(spark, tmp_path):
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/t", BPE)
    assert read_tokens(spark, f"{tmp_path}/t").count() == 0


# --- Mixing ----------------------------------------------------------------------------


def mix_rows(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "zz", "é", None])
        rows.append((i, source, " ".join(["w"] * rng.choice([0, 1, 3, 10, 200]))))
    return [*rows, (5, "a", "x y"), (5, "a", "x y"), (None, "b", "q " * 9), (n, "b", None)]


@pytest.fixture(params=["10000", "3"])
def arrow_rows(spark, request):
    """Rows of an Arrow batch: groups that end inside one, and groups over many."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("group", [4096, 7])
def test_mixture(spark, group, arrow_rows):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    df = df.withColumn("size", F.lit("x")).withColumn("part", F.lit(0)).withColumn("open", F.lit(1))
    got = mixing.mixture(df, group=group).collect()
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    target = brute.mix_targets(sizes)
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    by_size = {}
    for r in got:
        by_size.setdefault((r.source_size, round(r.target, 3)), []).append(r)
    for source, size in sizes.items():
        found = by_size[size, round(target[source], 3)]
        assert sum(r.taken for r in found) == pytest.approx(target[source], abs=1)
        whole = int(target[source] / size + 1e-9)
        assert sum(r.copies not in (0, whole, whole + 1) for r in found if r.size) <= 1
    again = mixing.mixture(df.repartition(5), group=group).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_pivot_keeps_means_and_words():
    rng = random.Random(2)
    for p, q, a, b in ((0.3, 0.6, 10, 25), (0.5, 0.5, 3, 3), (0.9, 0.2, 100, 1)):
        draws = [mixing.pivot(p, q, a, b, rng.random()) for _ in range(4000)]
        for x, y in draws:
            assert {x, y} & {0.0, 1.0} and 0 <= x <= 1 and 0 <= y <= 1
            assert x * a + y * b == pytest.approx(p * a + q * b, abs=1e-6)
        assert np.mean([x for x, _ in draws]) == pytest.approx(p, abs=0.03)
        assert np.mean([y for _, y in draws]) == pytest.approx(q, abs=0.03)


def test_mixed_rows_come_as_often_as_taken(spark):
    rows = mix_rows(3, 120)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    df = df.withColumn("_extra", F.lit(1))
    out = mixing.mixed(df)
    assert out.columns == df.columns
    taken = mixing.mixture(df, split_last=False).agg(F.sum("taken")).first()[0]
    assert sum(len(brute.words(r.text)) for r in out.collect()) == taken
    nothing = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mixed(nothing).count() == mixing.mixture(nothing).count() == 0


# --- URL rules -------------------------------------------------------------------------


def judged(url, rules, otherwise="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = host.translate(brute.LOWER)
    fit = [
        (len(h) + len(p), len(h), h, p, a)
        for a, h, p in rules
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, _, h, p, action = max(fit, default=(0, 0, None, None, otherwise))
    return host, path, h and h + p, action


def test_url_rules_equal_brute_force(spark):
    rng = random.Random(1)
    labels = ["net", "example", "a", "b", "com", "x-y", ""]
    hosts = [".".join(rng.choices(labels, k=rng.randint(1, 4))) for _ in range(40)]
    paths = ["", "/", "/en/", "/en/a", "/EN/", "/de", "/é/"]
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in
                  zip(rng.choices(hosts, k=60), rng.choices(paths, k=60))}.values())
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts).title()}{rng.choice(paths)}"
            f"{rng.choice(['', '?q=/en/', '#t', '?x://y'])}" for _ in range(400)]  # fmt: skip
    urls += [None, "", "no scheme.net/", "://net/", "http://", "http://net", "a\nb://net/\nen"]
    urls += ["http://example.net/en/"] * 300
    rows = list(enumerate(urls))
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    df = df.select("*", *[F.lit("x").alias(c) for c in ("host", "path", "stack", "key", "domain")])
    table = spark.createDataFrame([*rules, ("block", None, "/"), ("block", "", "/")], "action string, host string, path string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(df, table).collect()}
    for i, url in rows:
        assert got[i] == judged(url, rules), url
    none = table.limit(0)
    assert {r.rule for r in url_rules.judge_urls(df, none).collect()} == {None}
    assert url_rules.judge_urls(df.limit(0), table).count() == 0


def test_the_url_query_equals_its_sql(spark):
    pages = f"CREATE VIEW pages AS SELECT * FROM '{SF_DIR}/pages.parquet'"
    connection = duckdb.connect()
    connection.execute(pages)
    want = connection.execute(queries.ORACLES["op9_url_filters"]).fetchall()
    got = queries.QUERIES["op9_url_filters"](spark, SF_DIR)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


# --- Personal data ---------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pattern_spans(text):
    def fits(kind, found):
        digits = re.sub("[^0-9]", "", found)
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
        return {
            "email": True,
            "ip": kind == "ip" and all(int(p) <= 255 for p in found.split(".")),
            "card": 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
            "phone": 10 <= len(digits) <= 15,
        }[kind]

    return sorted(
        (m.start(), pii.KINDS.index(kind), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if fits(kind, m.group())
    )


def test_patterns_equal_the_plain_ones():
    rng = random.Random(1)
    parts = [*"0123456789..--  ++()@@abé%", "4465758382889437", "10.2.255.3", "+1 (743) 555-3824", "x.y@a.b.com"]
    for _ in range(20000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        assert pii.base_spans(text) == pattern_spans(text), text
    long = "a" * 200_000 + "1" * 200_000 + "." * 1000
    assert pii.base_spans(long) == []


def test_the_field_adds_what_stands_elsewhere(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        number = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        mail = f"user{i}@mail.example.com"
        rows.append((i, f"call {number} or write to {mail} now {i} then {mail}, or {number}."))
    rows += [(200, None), (201, ""), (202, "nothing here"), (None, "10.1.2.3"), (203, "12 34")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    weights = pii.fit_field(df)
    got = {r.doc_id: r for r in pii.find_personal_data(df, weights).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pattern_spans(text or ""))
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[i].spans.split(","))
    assert got[202].spans == got[203].spans == got[200].spans == ""
    assert got[None].n_ip == 1
    # The weights of equal words agree: what one is, the other is.
    assert (np.diag(weights.skip)[[1, 4]] > weights.skip[0, [1, 4]]).all()
    empty = df.limit(0)
    assert pii.find_personal_data(empty, pii.fit_field(empty)).count() == 0


def test_messages_carry_a_label_to_a_distant_twin():
    fields = pii.Fields()
    settings = pii.FieldSettings()
    text = "mail x@y.example.com and later x@y.example.com."
    fields.add(0, text, [(5, 0, 20)], settings.buckets)
    words = np.zeros((settings.buckets, pii.LABELS))
    skip = np.eye(pii.LABELS) * 4
    weights = pii.Weights(words, np.zeros((pii.LABELS, pii.LABELS)), skip)
    p = pii.marginals(fields, weights, settings)
    assert p[1].argmax() == 1 and p[1, 1] > 0.9
    assert pii.added_spans(fields, p, 0.9) == {0: [(31, 0, 46)]}


def test_a_label_reaches_repeats_at_any_distance():
    number, other = "+1 555-123-4567", "x5551234567x"
    settings = pii.FieldSettings()
    words = np.zeros((settings.buckets, pii.LABELS))
    skip = np.eye(pii.LABELS) * 4
    weights = pii.Weights(words, np.zeros((pii.LABELS, pii.LABELS)), skip)
    text = "call 555-123-4567 " + f"or {other} " * 60
    for spans in ([(5, 3, 17)], [(5, 3, 17), (text.rindex(other), 3, len(text) - 1)]):
        fields = pii.Fields()
        fields.add(0, text, spans, settings.buckets)
        p = pii.marginals(fields, weights, settings)
        assert len(p) == 61 and (p[:, 4] > 0.9).all()
        assert len(pii.added_spans(fields, p, 0.9)[0]) == 61 - len(spans)
        # What stands beside a document in its batch changes nothing.
        fields.add(1, f"{number} 123456 a 123456", [(0, 3, 15)], settings.buckets)
        assert (pii.marginals(fields, weights, settings)[:61] == p).all()


def test_cards_and_phones_are_found_in_other_spellings(spark):
    """No sample document has a repeat; later ones spell a number in ways of their own."""
    rng = random.Random(8)

    def card():
        while True:
            digits = "".join(rng.choice("0123456789") for _ in range(16))
            if pii._is_card(digits):
                return digits

    plain, spelled = [], []
    for i in range(200):
        number, phone = card(), f"1{rng.randint(200, 999)}555{rng.randint(1000, 9999)}"
        four = [number[k : k + 4] for k in range(0, 16, 4)]
        called = f"+{phone[0]} ({phone[1:4]}) {phone[4:7]}-{phone[7:]}"
        text = f"paid {i} times with {' '.join(four)} then rang {called} in room {i + 7} of {i * 31}"
        plain.append((i, text))
        if i < 40:
            long = "z9" * 50 + number
            again = f"{text} and {'.'.join(four)} or {'/'.join(four)} , {phone} ; {'. '.join(four)} {long}"
            spelled.append((1000 + i, again))
    weights = pii.fit_field(spark.createDataFrame(plain, "doc_id long, text string"))
    assert (np.diag(weights.skip)[[3, 4]] > 0.5).all()
    df = spark.createDataFrame(plain + spelled, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(df, weights).collect()}
    for i, text in plain:
        assert got[i] == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pattern_spans(text))
    added = 0
    for i, text in spelled:
        base = {f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pattern_spans(text)}
        found = set(got[i].split(","))
        assert base <= found
        more = {text[int(x.split(":")[1]) : int(x.split(":")[2])] for x in found - base}
        added += len(more)
        assert all(pii._digits(x) for x in more)
    # Dotted, slashed and spelled out, and the phone: at least three of them a text.
    assert added >= 3 * len(spelled)


def test_numbers_of_several_words_share_a_key():
    fields = pii.Fields()
    text = "4465 7583 8288 9437 x 7 4465 7583 8288 9437 1 y 4465-7583-8288-9437z"
    fields.add(0, text, [(0, 2, 19)], 64)
    assert [text[a:b] for a, b in zip(fields.start, fields.end)][:4] == text.split()[:4]
    # The first four words, the four within the longer run, and the one word.
    assert {(0, 5), (1, 6), (2, 7), (3, 8)} <= set(fields.skip)
    assert {(5, 10), (6, 10), (7, 10), (8, 10)} <= set(fields.skip)
    assert not any(4 in x or 9 in x for x in fields.skip)
    assert pii._shapes("a" * 500 + "1")[0].endswith("9" + "1,") and len(pii._shapes("a1" * 300)[1]) == 600


def test_messages_go_on_until_they_rest():
    settings = pii.FieldSettings()
    words = np.zeros((settings.buckets, pii.LABELS))
    chain = np.eye(pii.LABELS) * 9
    weights = pii.Weights(words, chain, np.zeros((pii.LABELS, pii.LABELS)))
    fields = pii.Fields()
    fields.add(0, " ".join(f"a{k}" for k in range(40)), [(0, 3, 2)], settings.buckets)
    p = pii.marginals(fields, weights, settings)
    # On a chain the rest is the exact marginal.
    one = np.exp(chain) / np.exp(chain).sum(axis=1)[0]
    exact = [np.linalg.matrix_power(one, k)[4, 4] for k in range(40)]
    assert np.allclose(p[:, 4], exact, atol=1e-2)


# --- Quality ---------------------------------------------------------------------------


def rated(spark, n=600):
    rng = random.Random(7)
    names = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = rng.choices(names, k=rng.randint(20, 60))
        kind = i % 6
        if kind == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "nasty"]))
        elif kind == 1:
            w = [x + rng.choice(["***", "###"]) for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, int(kind != 1), int(kind == 0)))
    return rows, labels


def test_held_out_grades(spark):
    rows, labels = rated(spark)
    documents = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(0))
    known = spark.createDataFrame(
        [*labels[:400], (1, None, 0), (None, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int"
    )
    model = fit_quality(documents, known, QualitySettings(sample=300))
    assert model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in grade_documents(documents, model).collect()}
    held = [got[i] for i in range(400, 600)]
    assert all(r.kept == (r.doc_id % 6 > 1) for r in held)
    assert all(0 <= r.p_good <= r.p_not_toxic <= 1 for r in held)
    assert np.mean([r.expected_grade for r in held if r.doc_id % 6 == 0]) < 0.5
    kept = keep_good(documents, model)
    assert kept.columns == documents.columns and kept.count() == sum(r.kept for r in got.values())


def test_features_that_tell_equal_brute_force(spark):
    """Counts by grade, document by document, and the distance from independence."""
    rows, labels = rated(spark, 240)
    rows += [rows[0], rows[0], (7, "another text of the same id")]
    grade = {i: 0 if toxic else 2 if good else 1 for i, good, toxic in labels[:200]}
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    known = spark.createDataFrame(labels[:200], "doc_id long, quality int, toxic int")
    settings = QualitySettings(least_chi_square=6.0)
    seen = _features(_rated(documents, known, settings), settings).cache()
    sets = []
    for i, text in sorted(set(rows)):
        if i in grade:
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            _, features = hashed_features(data, np.array([0, len(data)]), settings.bits)
            sets.append((grade[i], frozenset(features.tolist())))
    assert sorted((r.grade, sorted(r.features)) for r in seen.collect()) == sorted(
        (g, sorted(f)) for g, f in sets
    )
    share = [np.mean([g == k for g, _ in sets]) for k in range(3)]
    want = set()
    for feature in frozenset().union(*(f for _, f in sets)):
        count = [sum(feature in f for g, f in sets if g == k) for k in range(3)]
        off = sum((count[k] - sum(count) * share[k]) ** 2 / (sum(count) * share[k]) for k in range(3))
        if off >= 6.0:
            want.add(feature)
    assert {r.feature for r in _telling(seen, settings).collect()} == want and want
    # No more different rows than the sample, though ids repeat.
    few = QualitySettings(sample=50)
    many = documents.unionAll(documents.select("doc_id", F.concat("text", F.lit(" more"))))
    assert _features(_rated(many, known, few), few).count() == 50


def test_fit_is_where_the_dense_likelihood_is_flat():
    """The loss by a dense matrix: thresholds tried on a grid, weights by differences."""
    rng = np.random.default_rng(2)
    x = (rng.random((300, 8)) < 0.4).astype(float)
    score = x @ np.array([2.0, -2, 1, 0, 0, 1, -1, 0]) + rng.logistic(size=300)
    grade = np.digitize(score, [-1.0, 1.0])
    settings = QualitySettings(ridge=1e-3, steps=2000)
    rows, columns = np.nonzero(x)
    weights, bounds = fit_ordinal(rows, columns, grade, 8, settings)
    rarity = np.sqrt(300 / np.bincount(grade, minlength=3))[grade]
    rarity = rarity / rarity.sum()

    def loss(w, b):
        tails = 1 / (1 + np.exp(np.array(b)[:, None] - x @ w))
        p = np.stack([1 - tails[0], tails[0] - tails[1], tails[1]])
        return -(rarity * np.log(p[grade, np.arange(300)])).sum() + 5e-4 * (w**2).sum()

    least = loss(weights, bounds)
    grid = [(a, b) for a in np.arange(-4, 4, 0.1) for b in np.arange(-4, 4, 0.1) if a < b]
    assert least <= min(loss(weights, at) for at in grid) + 1e-6
    for k in range(8):
        step = np.eye(8)[k] * 1e-4
        slope = (loss(weights + step, bounds) - loss(weights - step, bounds)) / 2e-4
        assert abs(slope) < 1e-3


def test_grades_without_labels_and_of_odd_texts(spark):
    documents = spark.createDataFrame(
        [(1, None), (1, ""), (None, "x" * 300_000), (2, "\n\n")], "doc_id long, text string"
    )
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = fit_quality(documents, none)
    found = grade_documents(documents, model).collect()
    assert len(found) == 4 and all(r.kept and r.expected_grade == 2 for r in found)
    assert grade_documents(documents.limit(0), model).count() == 0
    rows, labels = rated(spark, 60)
    some = spark.createDataFrame(labels, none.schema)
    fitted = fit_quality(spark.createDataFrame(rows, "doc_id long, text string"), some)
    assert len(grade_documents(documents, fitted).collect()) == 4


# --- Pipeline --------------------------------------------------------------------------


def test_pipeline_stages_by_brute_force(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    steps = {}
    rows = documents
    for name, stage in corpus_pipeline.STAGES:
        rows = corpus_pipeline.store(stage(spark, rows, SF_DIR), "test-stage")
        steps[name] = rows
        if name != names[-1]:
            assert rows.columns == documents.columns
    good, first, clean, mix, tokens = (steps[n] for n in names)
    texts = [(r.doc_id, r.text) for r in good.collect()]
    want = sorted(i for i, (_, c) in brute.near(texts, size=5).items() if i == c)
    assert sorted(r.doc_id for r in first.collect()) == want
    left = brute.contaminated([x for x in texts if x[0] in set(want)], items)
    assert sorted(r.doc_id for r in clean.collect()) == [i for i in want if not left[i][4]]
    kept = {r.doc_id: r.text for r in clean.collect()}
    assert all(r.text == kept[r.doc_id] for r in mix.collect())
    assert tokens.count() == mix.count()
    last = tokens.orderBy(F.desc("start")).first()
    assert last.start + last.n_tokens == tokens.agg(F.sum("n_tokens")).first()[0]


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like those the stages use inside come out as they went in."""
    rows = [(i, f"{i} some words of the document number {i * i}", f"s{i % 2}") for i in range(40)]
    rows += [(3, rows[3][1], "s1"), (41, None, None), (None, "no id at all", "s0")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("_row_key", "_copies", "_copy", "_place", "_order", "row_key", "group", "n_words"):
        df = df.withColumn(name, F.concat_ws("-", F.lit(name), "source"))
    items = spark.createDataFrame([("b", rows[5][1])], "item_id string, text string")
    for kept in (keep_first(df), keep_uncontaminated(df, items), mixing.mixed(df)):
        assert kept.columns == df.columns
        got = kept.collect()
        assert len(got) > 30
        for r in got:
            assert (r.doc_id, r.text) in {(i, t) for i, t, _ in rows}
            assert r._row_key == "-".join(filter(None, ["_row_key", r.source]))
            assert r._copies == "-".join(filter(None, ["_copies", r.source]))
    assert 5 not in {r.doc_id for r in keep_uncontaminated(df, items).collect()}


def test_one_text_in_two_sources_is_two_documents(spark):
    rows = [(1, "a b c d", "s"), (1, "a b c d", "t")] + [(i, "x y", "s") for i in range(2, 9)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    taken = {r.source: r.words for r in got.groupBy("source").agg(
        F.sum(F.size(F.split("text", " "))).alias("words")).collect()}
    # s shares what t, which stops at twice its size, leaves of 33 words.
    assert taken["t"] == 8 and abs(taken["s"] - 25) <= 4
    same = [(1, "a b c d", "s")] * 3 + [(2, "a b", "t")] * 2
    got = mixing.mixed(spark.createDataFrame(same, "doc_id long, text string, source string"))
    assert sorted(tuple(r) for r in got.collect() if r.source == "t") == [(2, "a b", "t")] * 4


def test_one_of_equal_ids_and_texts_is_the_same_in_every_run(spark):
    rows = [(1, "one two three four five six", f"s{k}") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {keep_first(df.repartition(n)).first().source for n in (1, 2, 5)}
    assert len(found) == 1


def test_pipeline_stages_take_empty_tables(spark):
    empty = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


#: Audits have a row per order and step, searches one per anchor and place.
OTHER_ROWS = {"op11_filter_audit", "op12_hard_negatives"}


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - OTHER_ROWS))
def test_queries_read_their_whole_table(spark, name):
    table = {"op4": "embeddings", "op9": "pages"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert queries.QUERIES[name](spark, SF_DIR).count() == rows
