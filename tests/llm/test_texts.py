"""Operators on single texts, against the libraries or plain patterns."""

import hashlib
import random
import re
import struct
import time

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from starloom.llm import bpe, decontaminate, secrets, token_counts, toxicity
from llm_samples import AWKWARD, documents, prose  # noqa: F401

BPE, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [*"ab '\n\t \xa0　\x1c᠎,.!é▁😀\x00", "<|endoftext|>", "hello", "don't", " the", "  "]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 300))) for _ in range(n)]


def by_id(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


# ------------------------------------------------------------------- tokens


def test_pre_token_counts_add_up():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    lengths = token_counts._Lengths({}, PIECES, 50)
    for text in odd_texts(300):
        assert sum(lengths[k] for k in token_counts.pre_tokens(text)) == len(model.encode(text)), repr(text)


def test_token_counts(documents):
    pairs = AWKWARD + list(enumerate(odd_texts(40), 100))
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = by_id(token_counts.count_tokens(documents(pairs), PIECES, limit=50, entries=20, cache_entries=30))
    sizes = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in pairs]
    assert got == sorted(((*s, s[2] > 50) for s in sizes), key=lambda r: (r[0] is None, r[0] or 0))
    assert token_counts.count_tokens(documents([]), PIECES).count() == 0


def test_chunks_are_joined_exactly(monkeypatch):
    monkeypatch.setattr(bpe, "CUT_BITS", 4)
    library, table, rng = Tokenizer.from_file(BPE), bpe.token_bytes(BPE), random.Random(2)
    encoder = bpe.ChunkEncoder(BPE, np.zeros(0, np.int64), chunk_bytes=20_000, piece_entries=50)
    for text in odd_texts(300, 3):
        at = bpe.cuts(text.encode())
        keys = [bpe.digest(text.encode()[a:b]) for a, b in zip(at, at[1:]) if rng.random() < 0.7]
        encoder.shared = np.sort(np.array(keys, np.int64))
        ids = library.encode(text, add_special_tokens=False).ids
        for _ in range(2):  # the second time from kept chunks
            assert encoder.encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)
        assert bpe.decode_ids(encoder.encode(text), table) == library.decode(ids, skip_special_tokens=False)


def test_bpe_round_trip(documents):
    passage = " ".join(prose(random.Random(5), 400))
    pairs = AWKWARD + [(20 + i, f"{passage} {i}") for i in range(5)] + list(enumerate(odd_texts(20), 100))
    docs = documents(pairs)
    assert len(bpe.shared_chunks(docs)) > 0
    encoded = bpe.encode(docs, BPE, decoded=True)
    library = Tokenizer.from_file(BPE)
    want = []
    for i, t in pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), struct.pack(f"<{len(ids)}I", *ids), t or ""))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((i, n, bytes(b), t) for i, n, b, t in encoded.collect()), key=key) == sorted(want, key=key)
    assert sorted(r.text for r in bpe.decode(encoded, BPE).collect()) == sorted(t or "" for _, t in pairs)
    assert bpe.encode(documents([]), BPE).count() == 0


# ---------------------------------------------------------- decontamination


def brute_hits(text, items, window=13):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    ws, hit, ids = split(text), set(), set()
    for item, body in items:
        theirs = split(body)
        k = min(window, len(theirs))
        for a in range(len(theirs) - k + 1) if k else ():
            for b in range(len(ws) - k + 1):
                if ws[b : b + k] == theirs[a : a + k]:
                    hit.update(range(b, b + k))
                    if item is not None:
                        ids.add(str(item))
    return len(ws), len(hit), sorted(ids)


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_contamination_against_brute_force(spark, documents, block):
    rng = random.Random(7)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([30, 13, 12, 5, 1, 50])]
    items += [(9, "ab ab " * 20), (10, items[0][1]), (11, ""), (12, None), (None, " ".join(prose(rng, 20)))]
    pieces = [w for _, t in items for w in [(t or "").split()]]
    pairs = list(AWKWARD[:5]) + [(7, "ab " * 31)]
    for i in range(60):
        ws = prose(rng, rng.randint(0, 30))
        for p in rng.sample(pieces, 2):
            if p:
                a = rng.randint(0, len(p) - 1)
                ws[rng.randint(0, len(ws)) :][:0] = []
                at = rng.randint(0, len(ws))
                ws[at:at] = p[a : a + rng.randint(1, 30)]
        pairs.append((100 + i, ", ".join(w.upper() if rng.random() < 0.3 else w for w in ws)))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_contamination(documents(pairs), benchmark, automaton_bytes=block)
    want = sorted((i, *brute_hits(t, items)) for i, t in pairs)
    rows = sorted(found.collect())
    assert [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows] == want
    texts = dict(pairs)
    for r in rows:  # offsets are those of the text itself
        words = [w for s in r.spans for w in decontaminate.words(texts[r.doc_id][s.start : s.end].encode())]
        assert len(words) == r.n_hit
    dirty = {r.doc_id for r in rows if r.n_hit and 20 * r.n_hit >= r.n_words}
    kept = decontaminate.drop_contaminated(documents(pairs), benchmark, automaton_bytes=block)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in pairs if i not in dirty)


def test_automata_are_built_once_for_a_lot(spark, documents, monkeypatch):
    """Three megabytes of items: four automata for each 16 MB of texts, not each text."""
    rng = random.Random(8)
    items = [(i, " ".join(prose(rng, 150, [f"{rng.random():.9f}" for _ in range(40)]))) for i in range(1700)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert 3e6 < sum(len(t) for _, t in items) < 4e6
    scan = decontaminate._scanner(documents([]), benchmark, "item_id", "text", 13, 1 << 20)
    built, plain = [], decontaminate.Matcher
    monkeypatch.setattr(decontaminate, "Matcher", lambda *a: built.append(1) or plain(*a))
    texts = [items[k][1].encode() if k < 1700 else b"own words " * 1000 for k in range(0, 3400, 2)]
    parts = [(texts[k : k + 100], k) for k in range(0, len(texts), 100)]
    found = list(scan(parts))
    assert [k for k, _ in found] == [k for _, k in parts]
    hits = [(n, None if hit is None else int(hit.sum()), ids) for _, lot in found for n, hit, ids in lot]
    assert hits[:850] == [(n, n, {str(2 * k)}) for k, (n, _, _) in enumerate(hits[:850])]
    assert {h for _, h, _ in hits[850:]} == {None}
    assert len(built) == 4


def test_no_benchmark(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    found = decontaminate.find_contamination(documents(AWKWARD), none)
    assert {r.n_hit for r in found.collect()} == {0} and found.count() == len(AWKWARD)
    assert decontaminate.find_contamination(documents([]), none).count() == 0


# ------------------------------------------------------------------ secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def brute_spans(t):
    t = t or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def test_base_secrets_against_patterns(documents):
    rng = random.Random(11)
    parts = ["token = ", "API_KEY:'", "passwd", "ſecret=", "é", "AKIA", "ABCDEF123456", "0a1b2c3d" * 4, "short", '"', " ", "\n", "x9+/=._-"]
    pairs = AWKWARD + [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))) for i in range(200)]
    got = {}
    for r in secrets.find_secrets(documents(pairs)).collect():
        got.setdefault(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans])
    for i, t in pairs:
        assert [s for s in got[i] if s[0] != "literal"] == brute_spans(t), repr(t)
    assert secrets.find_secrets(documents([])).count() == 0


def test_literals_by_target_name():
    source = 'KEY = "q8Zr71LmX02p"\ncolour = "q8Zr71LmX02q"\ndb.password = KEY\nauth_token = "Ab12" + "cD34eF56"\npassword = "changeme"\n'
    found = [source[a:b] for kind, a, b in secrets.scan(source.encode()) if kind == "literal"]
    assert found == ["q8Zr71LmX02p", "Ab12", "cD34eF56"]
    config = b"client_secret: 'zX81-kkQ2_LLw'\nname: 'zX81-kkQ2_LLw'\n\"apiKey\": \"pQ7vT5bN3xKd\"\n"
    assert [config[a:b] for kind, a, b in secrets.scan(config) if kind == "literal"] == [b"zX81-kkQ2_LLw", b"pQ7vT5bN3xKd"]


def literals(source):
    return [source[a:b] for kind, a, b in secrets.scan(source.encode()) if kind == "literal"]


@pytest.mark.parametrize("word", [*secrets.SENSITIVE, "to_ken", "p_wd"])
def test_each_sensitive_word_alone(word):
    name = word if secrets.name_score(word) >= 2 else f"{word}_{'signing' if word == 'client' else 'client'}"
    for said in (name, name.upper()):
        assert literals(f'{said} = "q8Zr71LmX02pW4"') == ["q8Zr71LmX02pW4"], said


def test_long_constants_and_names():
    parts = [f"q{i}Zr" for i in range(100)]
    joined = " + ".join(f'"{p}"' for p in parts)
    assert literals(f"C = {joined}\ndb.password = C\n") == parts
    assert literals(f'{"x" * 300}_password = "q8Zr71LmX02pW4"') == ["q8Zr71LmX02pW4"]
    grown = "C = C + C\n" * 3000
    assert literals(f'C = "q8Zr71LmX02pW4"\n{grown}bearer = C\n') == ["q8Zr71LmX02pW4"]
    assert literals('A = "q8Zr71change"\nB = A + "me"\nbearer = B + "q8Zr71LmX02pW4"\n') == []


@pytest.mark.parametrize(
    "source",
    [
        'password: str = "{}"',
        "api_token: Optional[str] = '{}'",
        'let secret: &str = "{}";',
        'os.environ["API_TOKEN"] = "{}"',
        "config['db']['password'] = '{}'",
        'db_password = """{}"""',
        "db_password = '''{}'''",
        'password = f"{}"',
        "secret = b'{}'",
        "const apiKey = `{}`;",
        'password = (\n    "{}"\n)',
        'password = \\\n    "{}"',
        "password: |\n  {}\nname: x",
        "outer:\n  secret_key: >-\n    {}\n  other: y",
        "<password>{}</password>",
        '#define API_TOKEN "{}"',
        'db.password = KEY\nKEY = "{}"',
        'password: "{}"',
        "export TOKEN={}",
    ],
)
def test_literals_in_many_notations(source):
    for literal in ("q8Zr71LmX02pW4", "zX81-kkQ2_LLw9"):
        assert literals(source.replace("{}", literal)) == [literal]
        assert literals(source.replace("{}", "changeme")) == []
    plain = re.sub("(?i)password|passwd|api_?token|apikey|secret(_key)?|token", "colour", source)
    assert literals(plain.replace("{}", "q8Zr71LmX02pW4")) == []


def test_lexing_ends_on_anything():
    rng = random.Random(14)
    parts = ['"""', "'''", "password", " = ", ": ", "(", "\n", "  ", "|", "`", "\\", "<secret>", "</secret>", "#define ", "f", '"', "K1x9Qz", "[", "]", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        for kind, a, b in secrets.scan(text.encode()):
            assert 0 <= a < b <= len(text.encode())
    began = time.perf_counter()
    secrets.scan(b'password = """' * 4000 + b"token: int, " * 4000 + b"<secret>" * 4000)
    assert time.perf_counter() - began < 5


def test_literal_scores_over_parts():
    rng = random.Random(13)
    pieces = ["q8", "Zr 71", "place", "holder", "x", "xx", "é", "ß", "TODO", "your", "_", "${", "", "LmX02pW4"]
    for _ in range(2000):
        made = [rng.choice(pieces) for _ in range(rng.randint(0, 7))]
        cut = rng.randint(0, len(made))
        value = secrets.Value([secrets.Value([(p, 0, 0) for p in made[:cut]]), *((p, 0, 0) for p in made[cut:])])
        text = "".join(made)
        assert value.score() == secrets.literal_score(text)
        bad = len(text) < 6 or any(h in text.lower() for h in secrets.HARMLESS) or text[:2] in ("${", "{{", "<%")
        assert (value.score() == -9.0) == bad, text


# ----------------------------------------------------------------- toxicity


def test_toxicity_on_held_out_rows(spark, documents):
    rng = random.Random(13)
    pairs, labels = [], []
    for i in range(600):
        ws = prose(rng, rng.randint(5, 200))
        toxic = i % 4 == 0
        for _ in range(2 if toxic else 0):
            ws[rng.randint(0, len(ws)) :][:0] = []
            ws.insert(rng.randint(0, len(ws)), rng.choice(["grumblewort", "snarkfiend"]))
        pairs.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    docs = documents(pairs + [(1000, None), (1001, ""), (None, "snarkfiend grumblewort")])
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = {r.doc_id for r in docs.filter(toxicity.held_out()).collect()}
    assert 80 < len(held) < 160 and None not in held
    right = [(scores[i] >= 0.5) == bool(y) for i, y in labels if i in held]
    assert sum(right) / len(right) > 0.97
    assert scores[None] > 0.5 and scores[1000] == scores[1001] < 0.5
    kept = {r.doc_id for r in toxicity.keep_clean(docs, model).collect()}
    assert kept == {i for i, s in scores.items() if s < 0.5}
    assert toxicity.keep_clean(docs, model).columns == docs.columns


def test_toxicity_without_labels(spark, documents):
    docs = documents(AWKWARD)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(i, 0) for i in range(1, 7)], "doc_id bigint, toxic int")
    assert all(0 <= r.score < 0.5 for r in toxicity.score(docs, toxicity.fit(docs, one)).collect())


def test_digest_is_of_little_endian_ids():
    packed = bpe.ChunkEncoder(BPE, np.zeros(0, np.int64)).encode("hello")
    assert hashlib.sha256(packed).hexdigest() == hashlib.sha256(struct.pack("<I", 31373)).hexdigest()
