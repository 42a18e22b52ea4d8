"""Every stage of the pipeline against plain Python, on the smallest data and on odd rows."""

import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import line_dedup, toxicity
from llm_samples import AWKWARD, prose
from test_groups import Groups, line_pairs, near_texts, shingles_of

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, spot int, tag string, gone array<int>, key int, score double"


def odd_tables(spark, path):
    """Documents with nulls, empties, blanks, repeats, a very long text and columns whose
    names clash with those of the stages; labels and a benchmark for them."""
    rng = random.Random(31)
    mean = "awful hateful nasty stupid vile words".split()
    pairs = [p for p in line_pairs(rng) if p[0] is None or p[0] < 130]
    pairs += [(5000 + i, t) for i, t in near_texts(rng)[5:]]
    pairs += [(2000 + i, " ".join(rng.choice(mean if i % 2 else ["kind", "gentle", "calm", "nice"]) for _ in range(40))) for i in range(120)]
    for i in range(20):  # the same words on other lines
        ws = prose(random.Random(i % 6), 60)
        at = sorted(rng.sample(range(10, 50), 3))
        pairs.append((6000 + i, "\n".join(" ".join(ws[a:b]) for a, b in zip([0, *at], [*at, 60]))))
    items = [(i, " ".join(prose(rng, 30))) for i in range(6)] + [(6, None), (7, ""), (None, "x y")]
    pairs += [(3000 + i, f"{' '.join(prose(rng, 10))} {items[i % 6][1][: 40 * (1 + i % 5)]}") for i in range(30)]
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, "t", [1], 2, 0.5) for i, t in pairs]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = [(2000 + i, 1, i % 2) for i in range(120)] + [(i, 1, 0) for i, _ in pairs if i and not 2000 <= i < 3000]
    labels += [(2000, 1, None), (None, 0, 1), (9, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(docs):
    return [tuple(r) for r in docs.collect()]


def bag(rows):
    return sorted(map(repr, rows))


def after_toxicity(spark, docs, path):
    model = toxicity.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    scored = {}
    for row in rows_of(docs):
        text = (row[1] or "").encode()
        if text not in scored:
            at = {b for b in toxicity.buckets(text).tolist() if model.weights[b]}
            scored[text] = 1 / (1 + np.exp(-(model.bias + sum(model.weights[b] for b in sorted(at)))))
        if scored[text] < 0.5:
            yield row


def after_lines(docs):
    rows, where, want = rows_of(docs), {}, Groups()
    for i, t, *_ in rows:
        for no, line in enumerate((t or "").split("\n") if i is not None else ()):
            if line_dedup.compared(line):
                where.setdefault(line_dedup.compared(line), set()).add((i, no))
    kinds = sorted((k for k in where if len(k) >= 16), key=len)
    for n, a in enumerate(kinds):
        for b in kinds[n + 1 :]:
            if len(b) > len(a) + 2:
                break
            if line_dedup.within(a, b, min(2, len(a) // 16)):
                want.join(a, b)
    groups = {}
    for line, at in where.items():
        groups.setdefault(want.find(line), set()).update(at)
    gone = {p for at in groups.values() for p in at if p != min(at)}
    for i, t, lang, source, n, *rest in rows:
        lines = t.split("\n") if t is not None else []
        left = [x for no, x in enumerate(lines) if (i, no) not in gone]
        if len(left) == len(lines):
            yield i, t, lang, source, n, *rest
        elif any(line_dedup.compared(x) for x in left):
            yield i, "\n".join(left), lang, source, len("\n".join(left)), *rest


def after_near_duplicates(docs):
    rows, want = rows_of(docs), Groups()
    sets = [shingles_of(r[1]) for r in rows]
    by_token = {}
    for k, s in enumerate(sets):
        for token in s:
            by_token.setdefault(token, []).append(k)
    shared = {}
    for at in by_token.values():
        for j, a in enumerate(at):
            for b in at[:j]:
                shared[b, a] = shared.get((b, a), 0) + 1
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            want.join(a, b)
    least = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            least[want.find(k)] = min(row[0], least.get(want.find(k), row[0]))
    return [r for k, r in enumerate(rows) if r[0] is None or not sets[k] or r[0] == least[want.find(k)]]


def after_decontamination(spark, docs, path):
    split = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    windows = set()
    for r in spark.read.parquet(f"{path}/benchmark.parquet").collect():
        ws = split(r.text)
        k = min(13, len(ws))
        windows |= {tuple(ws[a : a + k]) for a in range(len(ws) - k + 1)} if k else set()
    sizes = {len(w) for w in windows}
    for row in rows_of(docs):
        ws, hit = split(row[1]), set()
        for k in sizes:
            for a in range(len(ws) - k + 1):
                if tuple(ws[a : a + k]) in windows:
                    hit.update(range(a, a + k))
        if not hit or 20 * len(hit) < len(ws):
            yield row


def after_encoding(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for i, t, *_ in rows_of(docs):
        ids = library.encode(t or "", add_special_tokens=False).ids
        data = struct.pack(f"<{len(ids)}I", *ids)
        text = library.decode(ids, skip_special_tokens=False)
        yield i, len(ids), sha(data), sha(text.encode()), data


@pytest.mark.parametrize("source", ["given", "odd"])
def test_each_stage_against_plain_python(spark, tmp_path, source):
    path = SF if source == "given" else odd_tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names, stages = docs.columns, dict(corpus_pipeline.STAGES)
    wanted = [
        ("toxicity", lambda d: after_toxicity(spark, d, path)),
        ("line_dedup", after_lines),
        ("near_duplicates", after_near_duplicates),
        ("decontaminate", lambda d: after_decontamination(spark, d, path)),
        ("bpe", after_encoding),
    ]
    assert [n for n, _ in wanted] == list(stages)
    for name, plain in wanted:
        out = f"{tmp_path}/out-{name}"
        stages[name](spark, docs, path).write.parquet(out)
        found = spark.read.parquet(out)
        assert bag(rows_of(found)) == bag(plain(docs)), name
        assert found.columns == (names if name != "bpe" else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])
        if name != "bpe":
            assert [t for _, t in found.dtypes] == [t for _, t in docs.dtypes]
            assert source == "given" or found.count() < docs.count()
            docs = found
    last = rows_of(found)
    assert bag(rows_of(corpus_pipeline.run(spark, path))) == bag(last)
    blank = {r[0] for r in spark.read.parquet(f"{path}/documents.parquet").filter("trim(coalesce(text, '')) = ''").collect()}
    assert all(n for i, n, *_ in last if i not in blank)


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_documents_alone(spark, tmp_path):
    """No labels, no benchmark: nothing is toxic, nothing contaminated."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "decontaminate"):
        assert stages[name](spark, docs, str(tmp_path)).count() == docs.count()
    assert docs.filter(F.col("doc_id").isNull()).isEmpty()


def test_odd_rows_hold_what_they_should():
    assert {t for _, t in AWKWARD} >= {None, "", " \n\t "} and any(i is None for i, _ in AWKWARD)
