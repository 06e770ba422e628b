"""Chat formatting, whitening and periodic runs against brute-force versions and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelforge.llm import chat_format, periodic_runs, queries, whitening

SF = "/root/testdata/sf0.001"
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def rows(df):
    return [tuple(r) for r in df.collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11 --------------------------------------------------------------

SAYS = "</s>[INST] ok [/INST]"


def digests(turns):
    """conv_id -> what read_back must find, from (conv, turn, role, text) in order."""
    by = {}
    for c, _, r, t in turns:
        by.setdefault(c, []).append((r or "", t or ""))
    out = {}
    for c, x in by.items():
        learned = "".join(t for r, t in x if r == "assistant")
        out[c] = (len(x), sha("".join(f"{r}\n{t}\n" for r, t in x)), len(learned), sha(learned))
    return out


def test_chat_query(spark):
    given_ = rows(spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    given_ += [(-1, 0, "user", SAYS), (-1, 1, "assistant", SAYS)]
    got = rows(queries.QUERIES["op11_chat_format"](spark, SF))
    assert {r[0]: r[1:5] for r in got} == digests(sorted(given_, key=lambda r: r[:2])) and len(got) > 2


CONTROLS = chat_format.control_strings(BYTE)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*CONTROLS, "<", "[", "\\", "s>", "/", "INST]", "a ", "é\0"]), max_size=9)
                .map("".join), max_size=5))
def test_escape_is_reversible_and_leaves_no_control_string(texts):
    done = chat_format.escape(pa.array(texts, pa.string()), CONTROLS).to_pylist()
    assert [chat_format.unescape(t, CONTROLS) for t in done] == texts
    assert not any(c in t for c in CONTROLS for t in done)


ODD_TURNS = [
    (1, 2, "assistant", SAYS + "<|endoftext|> <\\s> \\"), (1, 0, "system", ""), (1, 1, "user", None), (1, None, "user", "first"),
    (2, 0, None, "no role"), (2, 1, "tool[/ROLE]", "[ROLE]x[/TURN]"), (2, 1, "user", "same turn"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "é\0中 ß"), (3, 0, "assistant", "long " * 3000),
    (3, 1, "assistant", "repeated"), (3, 1, "assistant", "repeated"), (4, 0, "user", " \n\t "),
]


@pytest.mark.parametrize("limit", [1 << 18, 7, 1000])
def test_chat_odd(spark, limit):
    d = spark.createDataFrame([(*r, "x", 5) for r in ODD_TURNS],
                              "conv_id long, turn long, role string, text string, ids string, piece long")
    found = chat_format.format_conversations(d, BYTE, piece_tokens=limit)
    pieces = found.collect()
    assert all(len(p.input_ids) == len(p.loss_mask) == p.n_tokens <= limit for p in pieces)
    assert {p.conv_id for p in pieces if p.last} == {1, 2, 3, 4, None}
    order = sorted(ODD_TURNS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", 0))
    got = {r[0]: r[1:5] for r in rows(chat_format.read_back(found, BYTE))}
    assert got == digests(order)
    text = "".join(chat_format.render(np.array(p.input_ids), BYTE) for p in sorted(
        (p for p in pieces if p.conv_id == 2), key=lambda p: p.piece)) if limit > 7 else None
    if text:
        assert text == ("[ROLE][/ROLE]no role[/TURN][ROLE]tool[\\/ROLE][/ROLE][\\ROLE]x[\\/TURN][/TURN]"
                        "[INST]same turn[/INST]")


def test_chat_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_conversations(none, BYTE), BYTE).count() == 0


# ---- 12 --------------------------------------------------------------

def brute_whitening(vectors, k=4):
    """(id, component) -> (n, deviation, whitened, explained) of usable (id, vector) pairs, signs free."""
    x = {i: [int(np.floor(256 * float(c))) for c in v] for i, v in vectors}
    u = sorted({tuple(v) for v in x.values()})
    n, s = len(u), [sum(c) for c in zip(*u)]
    centred = np.array([[(n * a - b) / n for a, b in zip(v, s)] for v in u])
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1], q[:, ::-1]
    out = {}
    for i, v in x.items():
        far = [n * a - b for a, b in zip(v, s)]
        for c in range(min(k, len(e))):
            if e[c] > 1e-12 * e.sum():
                out[i, c + 1] = (n, sum(f * f for f in far), float(np.array(far) / n @ q[:, c] / np.sqrt(e[c])),
                                 float(e[c] / e.sum()))
    return out


def check_whitening(got, want):
    assert sorted(map(str, ((r[0], r[1]) for r in got))) == sorted(map(str, want))
    for c in {k[1] for k in want}:
        both = [(r, want[r[0], c]) for r in got if r[1] == c]
        sign = np.sign(sum(r[4] * w[2] for r, w in both))
        for r, w in both:
            assert (r[2], r[3]) == w[:2]
            assert abs(sign * r[4] - w[2]) < 1e-9 and abs(r[5] - w[3]) < 1e-9 and r[6] < 1e-9


def test_whitening_query(spark):
    given_ = rows(spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding"))
    check_whitening(rows(queries.QUERIES["op12_whitening"](spark, SF)), brute_whitening(given_))


def test_whitening_odd(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)           # sums are added up in tasks first
    rng = np.random.default_rng(0)
    good = [(i, [float(c) for c in rng.normal(size=3) * [9, 3, 1]]) for i in range(40)]
    good += [(100, good[0][1]), (101, [-0.0, 0.0, -1e-9]), (102, [1e4, -1e4, 1e4])]
    bad = [(200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 2.0]), (203, [float("inf"), 1.0, 1.0]),
           (204, []), (205, [1.0, 2.0]), (206, [1e30, 1.0, 1.0])]
    d = spark.createDataFrame([(i, v, "x", 1) for i, v in [*good, *bad, (100, good[0][1])]],
                              "vec_id long, embedding array<double>, __x string, id long").repartition(7)
    got = rows(whitening.transform(d, whitening.fit(d)))
    want = brute_whitening(good)
    assert len(got) == len(want) + 3                      # the repeated row
    check_whitening(list(dict.fromkeys(got)), want)


@pytest.mark.parametrize("vectors,components", [
    ([], 0), ([[1.0, 2.0]], 0), ([[1.0, 2.0], [1.0, 2.0]], 0), ([[1.0, 2.0], [2.0, 4.0], [3.0, 6.0]], 1),
    ([[0.0], [1.0]], 1), ([[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [0.0, -1.0]], 2)])
def test_whitening_small(spark, vectors, components):
    d = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    got = rows(whitening.transform(d, whitening.fit(d)))
    assert len(got) == components * len(vectors) and all(r[6] < 1e-9 for r in got)


def test_whitening_beyond_64_bits(spark):
    d = spark.createDataFrame([(1, [1e14, 0.0]), (2, [-1e14, 0.5]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = rows(whitening.transform(d, whitening.fit(d)))
    assert len(got) in (3, 6) and {r[3] for r in got if r[0] == 1} == {None}


def test_whitening_not_certified(spark):
    d = spark.createDataFrame([(i, [float(c) for c in np.random.default_rng(i).normal(size=40)]) for i in range(200)],
                              "vec_id long, embedding array<double>")
    with pytest.raises(whitening.NotCertified):
        whitening.fit(d, tolerance=0.0, guard=2, max_rounds=2)


# ---- 13 --------------------------------------------------------------

def runs_of(w, least=12):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                s = w[i:i + length]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10 ** 9), st.sampled_from([12, 12, 2, 3, 7]))
def test_word_runs(seed, least):
    rnd = random.Random(seed)
    texts = []
    for _ in range(rnd.randint(1, 4)):
        n, letters = rnd.randint(0, 70), rnd.choice([1, 2, 2, 3, 30])
        w = [rnd.randrange(letters) for _ in range(n)]
        if n and rnd.random() < 0.6:
            a, p = rnd.randrange(n), rnd.randint(1, 9)
            w = w[:a] + [w[a + (i - a) % min(p, n - a)] for i in range(a, n)]
        texts.append(w)
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    got = periodic_runs.word_runs(np.array(sum(texts, []), np.int64), bounds, least)
    assert [tuple(r) for r in got.tolist()] == [(t, *r) for t, w in enumerate(texts) for r in runs_of(w, least)]


def collapsed(w, found):
    drop = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def test_runs_query(spark):
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
        if len(w) < 3000:
            found = runs_of(w)
            best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
            want[r["doc_id"]] = (len(found), *best, 1000 * best[1] // best[2] if found else None,
                                 sha("".join("%d,%d,%d\n" % x for x in found)), sha(collapsed(w, found)))
    got = {r[0]: r[1:] for r in rows(queries.QUERIES["op13_periodic_runs"](spark, SF))}
    assert {d: got[d] for d in want} == want and len(want) > 150 and any(w[0] for w in want.values())


def test_runs_odd(spark, odd, none):
    got = periodic_runs.find_runs(odd).collect()
    assert len(got) == odd.count()
    long = next(r for r in got if r.doc_id == 4)
    assert [tuple(x) for x in long.runs] == [(0, 160000, 8)] and long.collapsed == "the cat and the dog of the house"
    by = {r.doc_id: (r.n_words, r.runs, r.collapsed) for r in got}
    assert by[1] == by[2] == by[3] == (0, [], "") and by[8] == (5, [], "Straße élève año 中文 ß")
    assert by[None][2] == "a row without id"
    assert periodic_runs.find_runs(none).count() == 0


@pytest.mark.parametrize("limit", [1, 50, 1 << 20])
def test_runs_slices(spark, limit):
    texts = ["a b\u000bc " * 9, None, "", "é " * 13 + "x", " x  y\n" * 6 + "x y z", "a b " * 12, "one two"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for r in periodic_runs.find_runs(d, slice_bytes=limit).collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        found = runs_of(w)
        assert [tuple(x) for x in r.runs] == found and r.collapsed == collapsed(w, found) and r.n_words == len(w)


def test_runs_of_one_word(spark):
    w = np.zeros(30000, np.int64)
    assert periodic_runs.word_runs(w, np.array([0, 30000])).tolist() == [[0, 0, 30000, 1]]
