"""Operators across texts, pages and vectors, against brute force."""

import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.context import scratch_path
from starloom.llm import ann, catalog, components, line_dedup, ngram_join, set_join, shingles, substring_dedup, warc
from starloom.llm.components import connected
from starloom.llm.hashing import mix, sorted_distinct
from llm_samples import AWKWARD, documents, prose  # noqa: F401


class Groups(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def test_connected(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(150)]
    want = Groups()
    for a, b in pairs:
        want.join(a, b)
    got = {r.id: r.comp for r in connected(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: want.find(x) for p in pairs for x in p if p[0] != p[1] or x in got}


# ------------------------------------------------------------- n-gram join


def shingles_of(text):
    ws = (text or "").encode().lower().split()
    return frozenset(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset()


def near_texts(rng):
    pairs = list(AWKWARD[:5]) + [(8, "two words"), (9, "Two  WORDS")]
    common = [prose(rng, 30) for _ in range(3)]
    for i in range(40):  # near copies of a few texts, some chained at the limit
        base = prose(random.Random(i % 5), 60 + 40 * (i % 5))
        for _ in range(rng.randint(0, 4)):
            base[rng.randint(0, len(base) - 1)] = rng.choice("xyz")
        pairs.append((100 + i, " ".join(base)))
    for i in range(40):  # made of passages that many share
        parts = [w for p in rng.sample(common, rng.randint(1, 3)) for w in p]
        pairs.append((200 + i, " ".join(parts + prose(rng, rng.randint(0, 12)))))
    return pairs + [(300 + i, " ".join(prose(rng, rng.randint(1, 9), ["a", "b"]))) for i in range(30)]


@pytest.mark.parametrize("rare_sets, most", [(8, 2_000_000), (2, 2_000_000), (0, 2_000_000), (1, 40)])
def test_ngram_join_against_all_pairs(documents, rare_sets, most):
    pairs = near_texts(random.Random(3))
    sets, want = [(i, shingles_of(t)) for i, t in pairs], Groups()
    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                want.join(i, j)
    got = ngram_join.near_duplicates(documents(pairs), rare_sets=rare_sets, most_frequent=most)
    assert sorted(map(tuple, got.collect())) == sorted((i, len(s), want.find(i)) for i, s in sets)


def test_one_of_each_group_stays(documents):
    pairs = near_texts(random.Random(4)) + [(None, "an id is missing here " * 3), (50, "an id is missing here " * 3)]
    docs = documents(pairs)
    named = ngram_join.near_duplicates(docs)
    alone = {r.doc_id for r in named.filter("doc_id = component_id OR doc_id IS NULL").collect()}
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in pairs if i in alone)
    assert ngram_join.near_duplicates(documents([])).count() == 0
    assert ngram_join.near_duplicates(documents([(1, None), (2, "")])).count() == 2


def test_sketches_never_part_linked_sets():
    rng = np.random.default_rng(5)
    for percent in (50, 80, 85):
        groups = []
        for _ in range(150):
            n = int(rng.integers(1, rng.choice([20, 900, 12_000])))
            x = sorted_distinct(rng.integers(0, 1 << 63, n).astype(np.uint64))
            y = x[rng.random(len(x)) >= rng.choice([0.0, 0.05, 0.12])]
            y = sorted_distinct(np.concatenate((y, rng.integers(0, 1 << 63, int(n * 0.05)).astype(np.uint64))))
            groups += [x, y] if len(y) else [x]
        marks = [shingles.mark(x) for x in groups]
        i, j = np.triu_indices(len(marks), 1)
        met = shingles.near(shingles.table(marks), i, j, percent)
        found = {frozenset(p) for p in zip(i[met].tolist(), j[met].tolist())}
        linked = 0
        for a, x in enumerate(groups):
            for b in range(max(0, a - 1), a):
                alone = shingles.near(shingles.table([marks[a], marks[b]]), np.array([0]), np.array([1]), percent)
                assert alone[0] == (frozenset((a, b)) in found)
                if shingles.links(x.tobytes(), groups[b].tobytes(), percent):
                    assert frozenset((a, b)) in found
                    linked += 1
        assert linked > 20


def overlapping(n, m, same, often):
    """Two sets of n and m tokens with ``same`` in common; ``often`` of all are frequent."""
    tokens = np.random.default_rng([n, m, same]).permutation(sorted_distinct(mix(np.arange(1, n + m - same + 1).astype(np.uint64))))
    x, y = np.sort(tokens[:n]), np.sort(tokens[n - same :])
    frequent = np.sort(tokens[np.random.default_rng([n, m]).random(len(tokens)) < often])
    return x, y, frequent


@pytest.mark.parametrize("percent", [50, 55, 60, 67, 70, 75, 80, 85, 90, 95, 100])
@pytest.mark.parametrize("often", [0.0, 0.3, 0.8, 1.0])
def test_sets_that_barely_link_share_a_signature(percent, often):
    for n in range(1, 61):
        for m in range(n, 2 * n + 1):
            same = -(-percent * (n + m) // (100 + percent))  # the least that links
            if same > n or n == m == same:
                continue
            x, y, frequent = overlapping(n, m, same, often)
            assert shingles.links(x.tobytes(), y.tobytes(), percent)
            assert np.intersect1d(ngram_join.signatures(x, frequent, percent), ngram_join.signatures(y, frequent, percent)).size, (n, m)


def test_four_of_five_shingles_link(documents):
    pairs = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "a b c d e f g"), (4, "a b c d e f g h x y")]
    got = ngram_join.near_duplicates(documents(pairs))
    assert sorted(map(tuple, got.collect())) == [(1, 4, 1), (2, 5, 1), (3, 3, 3), (4, 6, 4)]


@pytest.mark.parametrize("star_rounds", [0, 1, 3])
@pytest.mark.parametrize("cell", [3, 2048])
def test_components_of_large_buckets(spark, monkeypatch, cell, star_rounds):
    """Numbers link if they differ by two at most; buckets of many, over blocks."""
    monkeypatch.setattr(components, "CELL", cell)
    rng = random.Random(cell)
    numbers = rng.sample(range(400), 120)
    buckets = [(n // 90, n) for n in numbers] + [((n + 2) // 90, n) for n in numbers] + [(100 + n, n) for n in numbers]
    want = Groups()
    for a in numbers:
        for b in numbers:
            if 0 < b - a <= 2:
                want.join(a, b)
    postings = spark.createDataFrame([(32 * s + t, i) for s, i in buckets for t in ({0} if s >= 100 else {0, i % 3})], components.POSTINGS)
    shared = components.shared_buckets(postings)
    marks = spark.createDataFrame([(n, n // 3, n.to_bytes(8, "little")) for n in numbers], "id bigint, lane bigint, mark binary")
    tested = []

    def test(pairs):
        tested.extend(pairs.collect())
        return pairs.filter("b - a <= 2")

    def table(marks):
        return np.array([int.from_bytes(m, "little") for m in marks])

    def near(held, i, j):
        return np.abs(held[i] - held[j]) <= 4

    found = components.linked_components(shared, test, marks, table, near, star_rounds=star_rounds)
    got = {r.id: r.comp for r in found.collect()}
    assert {n: got.get(n, n) for n in numbers} == {n: want.find(n) for n in numbers}
    assert all(r.a < r.b for r in tested)


def test_often_posted_signatures_are_salted():
    posted = components.Poster(flush=1000)
    for i in range(400):
        full = posted.add(np.array([7, 1000 + i, 8 if i < 5 else 5000 + i], np.uint64) * np.uint64(32), i)
        assert full == (i >= 333)
    rows = [(s // 32, s % 32, i) for s, i in zip(*(c.to_pylist() for c in posted.take().columns))]
    assert len(rows) == 1200 and sorted(i for s, _, i in rows if s == 7) == list(range(400))
    assert sum(t == 0 for s, t, _ in rows if s == 7) == components.OFTEN
    assert {t for s, t, _ in rows if s != 7} == {0} and len({t for s, t, _ in rows if s == 7}) > 20
    assert posted.take().num_rows == 0


def candidates(spark, n):
    """Texts on one frame that many share, all different beyond it: no links."""
    rng = random.Random(n)
    frame = prose(random.Random(1), 60)
    rows = [(i, " ".join(frame + prose(rng, 60))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = []
    filter_pairs = set_join.filter_pairs
    set_join.filter_pairs = lambda pairs, *rest: made.append(pairs.count()) or filter_pairs(pairs, *rest)
    try:
        got = ngram_join.near_duplicates(docs)
        assert got.filter("component_id <> doc_id").isEmpty()
    finally:
        set_join.filter_pairs = filter_pairs
    return sum(made)


def test_candidates_follow_the_input(spark):
    few, many = candidates(spark, 150), candidates(spark, 750)
    assert many <= 7 * few + 1000


# ------------------------------------------------------- long repeated spans


def brute_repeats(pairs, window):
    seen = defaultdict(list)
    for i, t in pairs:
        ws = (t or "").encode().split()
        for a in range(len(ws) - window + 1) if i is not None else ():
            seen[tuple(ws[a : a + window])].append(i)
    out = []
    for i, t in pairs:
        ws = (t or "").encode().split()
        cut = set()
        for a in range(len(ws) - window + 1) if i is not None else ():
            if min(seen[tuple(ws[a : a + window])]) < i:
                cut.update(range(a, a + window))
        out.append((i, len(ws), len(cut), b" ".join(w for k, w in enumerate(ws) if k not in cut).decode()))
    return out


def test_repeats_against_all_windows(documents):
    rng = random.Random(9)
    passages = [prose(rng, n) for n in (50, 51, 70, 130)] + [["same"] * 80, ["ab", "cd"] * 40]
    pairs = list(AWKWARD)
    for i in range(60):
        ws = prose(rng, rng.randint(0, 40))
        for p in rng.sample(passages, 2):
            a = rng.choice([0, 0, rng.randint(0, 20)])
            ws += p[a : a + rng.choice([30, 49, 50, 200])] + prose(rng, rng.randint(0, 3))
        pairs.append((rng.randint(100, 145), " ".join(ws)))  # some ids twice, with other texts
    pairs += [(200, pairs[20][1]), (201, pairs[20][1]), (201, pairs[20][1])]
    got = substring_dedup.remove_repeats(documents(pairs))
    key = lambda r: (str(r[0]), r[3])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_repeats(pairs, 50), key=key)
    assert substring_dedup.remove_repeats(documents([])).count() == 0


# -------------------------------------------------------------------- lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, line, n):
    line = list(line)
    for _ in range(n):
        at = rng.randint(0, len(line))
        line[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "é"])
    return "".join(line)


def test_edit_distance():
    rng = random.Random(15)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        b = edited(rng, a, rng.randint(0, 4))
        k = rng.randint(0, 3)
        assert line_dedup.within(a, b, k) == (distance(a, b) <= k)


def limit(a, b, edits=2):
    return min(edits, min(len(a), len(b)) // 16)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_lines_share_a_signature_and_meet(edits):
    rng = random.Random(16)
    pairs = []
    while len(pairs) < 1500:
        a = "".join(rng.choice("abcd é") for _ in range(rng.randint(14, 90)))
        b = edited(rng, a, rng.randint(1, edits))
        if a != b and distance(a, b) <= limit(a, b, edits):
            pairs.append((a, b))
    lines = [x for p in pairs for x in p]
    sigs, places = line_dedup.signatures(lines, edits)
    held = defaultdict(set)
    for s, p in zip(sigs.tolist(), places.tolist()):
        held[p].add(s)
    marks = line_dedup.table([line_dedup.mark(x) for x in lines])
    even = np.arange(0, len(lines), 2)
    assert line_dedup.near(marks, even, even + 1, edits).all()
    for k in range(len(pairs)):
        assert held[2 * k] & held[2 * k + 1], pairs[k]


def line_pairs(rng):
    """Texts of near, equal and short lines of 1 to 80 characters, blanks, repeats."""
    bases = [" ".join(prose(rng, n)) for n in (4, 6, 8, 12)] + ["".join(rng.choice("abcdef") for _ in range(n)) for n in range(1, 81, 4)]
    marks = ["Menu", "menu", "Read more", "x", "é", "-", "a" * 31, "a" * 30 + "b", "b" * 32, "b" * 31, "b" * 16, "b" * 15]
    pairs = list(AWKWARD)
    for i in range(60):
        lines = [edited(rng, rng.choice(bases), rng.choice([0, 1, 2, 5])) for _ in range(rng.randint(0, 5))]
        lines += [rng.choice(["", " "]) + rng.choice([*marks, f"own {i}"]) + rng.choice(["", " \r"]) for _ in range(4)]
        lines += ["", " \t"]
        rng.shuffle(lines)
        pairs.append((100 + i, "\n".join(lines)))
    return pairs + [(300, "Menu\nmenu"), (301, "Menu\n \n"), (302, "a line of its own\nMenu")]


def kept_lines(pairs):
    """(doc_id, text, lines, lines taken out) of each row, from all pairs of lines."""
    where, want = defaultdict(list), Groups()
    for i, t in pairs:
        for no, line in enumerate((t or "").split("\n") if i is not None else ()):
            if line_dedup.compared(line):
                where[line_dedup.compared(line)].append((i, no))
    kinds = list(where)
    for n, a in enumerate(kinds):
        for b in kinds[:n]:
            if limit(a, b) and abs(len(a) - len(b)) <= 2 and len(a) < 1000 and distance(a, b) <= limit(a, b):
                want.join(a, b)
    groups = defaultdict(list)
    for line, at in where.items():
        groups[want.find(line)] += at
    gone = {p for at in groups.values() for p in at if p != min(at)}
    texts = []
    for i, t in pairs:
        lines = t.split("\n") if t is not None else []
        left = [x for no, x in enumerate(lines) if (i, no) not in gone]
        texts.append((i, t if t is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return texts


@pytest.mark.parametrize("seed", [17, 18])
def test_lines_against_all_pairs(documents, seed):
    pairs = line_pairs(random.Random(seed))
    docs = documents(pairs)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    found = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()]
    assert sorted(found, key=str) == sorted(kept_lines(pairs), key=str)
    assert line_dedup.dedup_lines(documents([])).count() == 0


def test_emptied_documents_go_and_columns_stay(spark, documents):
    pairs = line_pairs(random.Random(19))
    names = ["doc_id", "text", "n_lines", "spot", "tag", "gone", "n_removed"]
    docs = documents(pairs).select("doc_id", "text", "n_words", "key", "tag", "lang", "score").toDF(*names)
    got = line_dedup.strip_repeats(docs, length="n_lines")
    assert got.columns == names
    want = []
    for (i, t), (_, left, _, n) in zip(pairs, kept_lines(pairs)):
        if not n or any(line_dedup.compared(x) for x in left.split("\n")):
            want.append((i, left, len(left) if n else 7, "x", 0, "en", 1.5))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_registered_line_removal_takes_short_repeats(spark, documents, tmp_path):
    documents([(1, "Menu\nfirst"), (2, "Menu\nsecond"), (3, "Menu")]).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_removed for r in catalog.op9_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 1, 3: 1}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("n_chars", F.length("text").cast("bigint"))
    cut = corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path))
    assert {(r.doc_id, r.text, r.n_chars) for r in cut.collect()} == {(1, "Menu\nfirst", 10), (2, "second", 6)}


# ------------------------------------------------------------------ vectors


@pytest.mark.parametrize("most", [1024, 6])
def test_search_recall_and_order(spark, monkeypatch, most):
    monkeypatch.setattr(ann, "MOST_CENTRES", most)
    rng = np.random.default_rng(21)
    centres = rng.standard_normal((20, 24))
    x = (centres[rng.integers(0, 20, 4000)] + 0.5 * rng.standard_normal((4000, 24))).astype(np.float32)
    x *= rng.uniform(0.3, 3, 4000).astype(np.float32)[:, None]  # lengths differ
    x[1000:1400] = x[999]  # ties
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(9001, None, 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] * 24, 1), (9004, [None] * 24, 1), (9005, [1.0], 1), (9006, [], 1), (None, rows[0][1], 1)]
    vectors = spark.createDataFrame(rows + odd + rows[:3], "vec_id bigint, embedding array<float>, list int")
    got = ann.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20, fit_rows=1500)
    found = defaultdict(list)
    for r in sorted(got.collect()):
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(found) == set(range(0, 4000, 20))
    x, recall = x.astype(np.float64), []
    for q, hits in found.items():
        dots = x @ x[q]
        dots[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -dots))[:20]
        recall.append(len({v for _, v, _ in hits} & set(best.tolist())) / 20)
        assert [h[0] for h in hits] == list(range(1, 21))
        assert [(-round(s, 9), v) for _, v, s in hits] == sorted((-round(s, 9), v) for _, v, s in hits)
        assert all(abs(s - dots[v]) < 1e-9 for _, v, s in hits)
    assert np.mean(recall) >= 0.95
    index = ann.build(ann.one_each(ann.usable(vectors, "vec_id", "embedding")), 20, 1500)
    assert (len(index.inner) > 1) == (most == 6) and 60 <= index.lists <= 70 and index.probes < index.lists
    few = vectors.filter("vec_id < 5")
    assert ann.search(few, few, k=20).count() == 20  # four others each
    assert ann.search(vectors.filter("vec_id > 9000 AND vec_id <> 9005"), vectors, k=3).count() == 0
    assert ann.search(vectors.limit(0), vectors.limit(0)).count() == 0


def test_several_vectors_of_one_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 9.0]), (1, [0.0, 9.0]), (2, [2.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, ann.search(vectors, vectors.filter("vec_id = 1"), k=5).collect()))
    assert got == [(1, 1, 2, 9.0), (1, 2, 3, 9.0)]


# --------------------------------------------------------------------- WARC


def test_chunked_framing():
    rng = random.Random(23)
    for n in (0, 1, 7, 8, 9, 100):
        payload = bytes(rng.randrange(256) for _ in range(n))
        assert warc.unchunked(warc.chunked(payload, 8)) == payload
    assert warc.unchunked(b"5\r\nabc") is None and warc.unchunked(b"") is None


def test_archives_round_trip(spark):
    rng = random.Random(25)
    bodies = [None, "", "x", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n", "é😀" * 300, "\r\n\r\n0\r\n", "<p>" + "y" * 5000]
    rows = [(i, None if i % 7 == 0 else f"http://h/{i}?a b", rng.choice(bodies + [f"own {i} " * i]), 1) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, first int")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, segment_bytes=200)
    raw = warc.read_records(spark, path)
    assert raw.filter("record_type = 'continuation'").count() > 20
    records = warc.read_archives(spark, path)
    firsts = {}
    for i, _, h, _ in rows:
        firsts.setdefault(h or "", i)
    want = {}
    for i, _, h, _ in rows:
        data, first = (h or "").encode(), firsts[h or ""]
        again = first != i
        want[i] = (len(data), warc.payload_digest(data), "revisit" if again else "response", first if again else None)
    got = {r.page_id: tuple(r)[1:] for r in warc.index(records).collect()}
    assert got == want
    payloads = {r.page_id: r.payload for r in records.filter("record_type = 'response'").collect()}
    assert all(bytes(p).decode() == (rows[i][2] or "") for i, p in payloads.items())
    empty = scratch_path(spark, "warc")
    warc.write_archives(pages.limit(0), empty)
    assert warc.index(warc.read_archives(spark, empty)).count() == 0


def test_repeated_and_unnamed_pages_against_sql(spark, tmp_path):
    long, other, plain = "<p>" + "z" * 70_000, "y" * 40_000, "short"
    rows = [(1, "u", long), (1, "u", long), (2, "u", long), (None, "u", long), (3, "u", plain), (3, "u", plain)]
    rows += [(None, "v", other), (None, "v", other), (None, None, plain), (4, "w", None), (4, "w", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(2)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(catalog.ORACLES["op10_warc"]).fetchall()
    got = [tuple(r) for r in catalog.op10_warc(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows) and sorted(got, key=str) == sorted(want, key=str)
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    raw = warc.read_records(spark, path)
    assert raw.count() == raw.select("record_id").distinct().count()


def test_a_missing_segment_is_noticed(spark):
    path = scratch_path(spark, "warc")
    page = (7, "u", b"z" * 900, None)
    records = list(warc.page_records(*page, 200))
    kept = [r[:-1].decode() for k, r in enumerate(records) if k != 2]
    spark.createDataFrame([(r,) for r in kept], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    (row,) = warc.read_archives(spark, path).collect()
    assert row.page_id == 7 and row.payload is None
