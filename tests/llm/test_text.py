"""Byte-level BPE, language ID, personal data, quality."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import struct
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import bpe, catalogue, langid, pii, quality
from tests.llm.fixtures import SF, corpus, documents, odd_rows, sentence, with_clashes

PATH = P.path("byte_bpe_50k.tiktoken")


# ---- byte-level BPE --------------------------------------------------------
@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(text: str) -> list[int]:
    import regex

    codec = bpe.load(PATH)
    return [i for piece in regex.findall(P.PATTERN, text) for i in codec.encode_piece(piece.encode())]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_bpe_equals_the_library(reference, text):
    assert encoded(text) == reference.encode_ordinary(text)
    assert bpe.load(PATH).decode(bpe.pack(encoded(text))) == text.encode()


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 20_000, "the" * 10_000, "<|endoftext|>", "éé" * 5000])
def test_bpe_of_long_pieces(reference, text):
    assert encoded(text) == reference.encode_ordinary(text)


def test_bpe_merges_a_lower_rank_that_appears_late():
    # "abc" ranks below "ab", so merging ab opens a pair that goes before the other ab
    codec = bpe.Codec({b"a": 0, b"b": 1, b"c": 2, b"abc": 3, b"ab": 4, b"cab": 5})
    assert codec.encode_piece(b"abcab") == [3, 4]
    assert codec.encode_piece(b"zz"[:0]) == []


def test_bpe_query_rows(spark, reference):
    rows = corpus(12) + odd_rows()
    got = bpe.digests(with_clashes(documents(spark, rows)), PATH, P.PATTERN).collect()
    want = []
    for doc_id, text, *_ in rows:
        ids = reference.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.digests(documents(spark, []), PATH, P.PATTERN).collect() == []
    apart = bpe.decode(bpe.encode(documents(spark, rows), PATH, P.PATTERN), PATH)
    together = bpe.round_trip(documents(spark, rows), PATH, P.PATTERN)
    assert sorted(map(str, apart.select(together.columns).collect())) == sorted(map(str, together.collect()))


def test_bpe_forgets_rare_pieces(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    pieces = bpe.Pieces(bpe.load(PATH))
    for piece in [" one", " two", " three", " qqz", " one", " zzq", " two"] * 3:
        assert pieces[piece] == bpe.pack(reference.encode_ordinary(piece))
    assert len(pieces) <= 3 and len(pieces.older) <= 3


# ---- language ID -----------------------------------------------------------
def brute_viterbi(scores, penalty):
    state, back = list(scores[0]), []
    for row in scores[1:]:
        best = max(range(len(state)), key=lambda k: state[k])
        back.append([k if state[k] >= state[best] - penalty else best for k in range(len(state))])
        state = [max(state[k], state[best] - penalty) + row[k] for k in range(len(state))]
    k = max(range(len(state)), key=lambda k: state[k])
    path = [k]
    for step in reversed(back):
        k = step[k]
        path.append(k)
    return path[::-1]


def test_viterbi_against_brute_force():
    rng = np.random.default_rng(3)
    sizes = np.array([0, 5, 1, 17, 0, 9, 17])
    scores = rng.normal(size=(int(sizes.sum()), 3)).astype(np.float32) * 3
    got, at = langid.viterbi(scores, sizes, 4.0), 0
    for n in sizes:
        if n:
            assert got[at : at + n].tolist() == brute_viterbi(scores[at : at + n].astype(float).tolist(), 4.0)
        at += n


def test_mixed_text_has_spans(spark):
    model = langid.train(documents(spark, corpus(120)))
    rng = random.Random(5)
    german, french = sentence(rng, "de", 30), sentence(rng, "fr", 20)
    text = german + ". " + french
    languages, values, spans = langid.label(model, [text, "", None, "123", "ελληνικά"])
    assert languages == ["de", "und", "und", "und", languages[4]] and languages[4] in model.languages
    assert 0.5 < values[0] < 0.8 and values[1:] == [0.0] * 4
    assert [s["lang"] for s in spans[0]] == ["de", "fr"]
    assert abs(spans[0][1]["start"] - len(german) - 2) <= 12 and spans[0][1]["end"] == len(text)


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, "привет мир как дела", "ru", "h", 0) if i % 2 else (i, "hello world how are things", "en", "h", 0) for i in range(40)]
    model = langid.train(documents(spark, rows))
    assert langid.label(model, ["совсем другое слово", "zzz qqq"])[0] == ["ru", "en"]
    assert langid.label(model, ["hello world привет мир как дела привет"])[2][0] == [
        {"start": 0, "end": 11, "lang": "en"},
        {"start": 12, "end": 38, "lang": "ru"},
    ]


def test_language_query(spark):
    rows = corpus(90) + odd_rows()
    got = langid.identify(with_clashes(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    known = {r[0]: r for r in rows[:90]}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id in known:
            assert r.lang_pred == known[r.doc_id][2]
    assert {r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002, 1005)} == {"und"}
    nothing = langid.identify(documents(spark, [(1, "text", None, "h", 4)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert langid.identify(documents(spark, [])).collect() == []


def test_language_is_right_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = catalogue.QUERIES["op4_langid"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20 and all(r.lang == r.lang_pred for r in got)


# ---- personal data ---------------------------------------------------------
def plain_spans(t: str) -> list[tuple]:
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@-b1 2+0(5)_9x٣", max_size=50))
def test_base_spans_equal_the_patterns(text):
    assert pii.detect(text) == plain_spans(text)
    assert [(s["kind"], s["start"], s["end"]) for s in pii.spans(text) if s["base"]] == sorted(
        plain_spans(text), key=lambda s: (pii.KINDS.index(s[0]), s[1])
    )


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["one", "two", " ", "-", " dot ", " at ", "[at]", "(.)", "oh", "un", "а", "５", "x", "9", "+", "@", "​", "plus ", "-at-", "_dot_", ", ", "double ", "\t", "  ", "-dot-", ".", "_", "a.b at c.d", "(", " \n)"]), max_size=20).map("".join))
def test_the_quick_test_misses_no_change(text):
    mapped = pii.normalise(text)
    assert len(mapped.text) == len(mapped.start) == len(mapped.end)
    assert mapped.text == text or pii.may_be_disguised(text)
    for a, b in zip(mapped.start.tolist(), mapped.end.tolist()):
        assert 0 <= a < b <= len(text)


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"),
        ("bob(at)site(dot)net", "email", "bob(at)site(dot)net"),
        ("write to doe at mail dot example dot org", "email", "doe at mail dot example dot org"),
        ("it is jane dot q dot doe at example dot org", "email", "jane dot q dot doe at example dot org"),
        ("joe-at-example-dot-com", "email", "joe-at-example-dot-com"),
        ("mail jane.doe at example.com today", "email", "jane.doe at example.com"),
        ("mail jane  at  example  dot  com today", "email", "jane  at  example  dot  com"),
        ("jane at\texample dot com", "email", "jane at\texample dot com"),
        ("jane at\n example\r\ndot com", "email", "jane at\n example\r\ndot com"),
        ("(joe-at-example.com)", "email", "joe-at-example.com"),
        ("joe_at_example_dot_com", "email", "joe_at_example_dot_com"),
        ("jane.doe@" + "x" * 70 + " dot com", "email", "jane.doe@" + "x" * 70 + " dot com"),
        ("jane dot " * 200 + "doe at example dot org", "email", "jane dot " * 200 + "doe at example dot org"),
        ("jane dot doe at example.org", "email", "jane dot doe at example.org"),
        ("jane\t[at]\texample [dot]  com", "email", "jane\t[at]\texample [dot]  com"),
        ("j_9 at mail.example.com", "email", "j_9 at mail.example.com"),
        ("plus one\tfour one five  five five five\nzero one zero zero", "phone", "plus one\tfour one five  five five five\nzero one zero zero"),
        ("host 10  dot 0\tdot 0 dot 1", "ip", "10  dot 0\tdot 0 dot 1"),
        ("𝐣𝐨𝐞@𝐬𝐢𝐭𝐞.𝐜𝐨𝐦", "email", "𝐣𝐨𝐞@𝐬𝐢𝐭𝐞.𝐜𝐨𝐦"),
        ("plus four four, two oh, double seven, nine four six, triple zero", "phone", "plus four four, two oh, double seven, nine four six, triple zero"),
        ("аdmin@exаmple.com", "email", "аdmin@exаmple.com"),
        ("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("plus one four one five five five five one two one two", "phone", "plus one four one five five five five one two one two"),
        ("host 192 dot 168 dot 1 dot 1 is", "ip", "192 dot 168 dot 1 dot 1"),
        ("10[.]0[.]0[.]1", "ip", "10[.]0[.]0[.]1"),
        ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("x​y@e.com", "email", "x​y@e.com"),
    ],
)
def test_disguises(text, kind, span):
    assert (kind, span) in [(s["kind"], text[s["start"] : s["end"]]) for s in pii.spans(text)]


@pytest.mark.parametrize("text", ["look at example.com", "one two three four", "he was at the dot", "un deux trois", "see you at nine dot", "a stay-at-home day", "one, two, three, go", "look  at\texample.com", "state-of-the-art x-dot-y", "we met at 3.15 at the x", "3.15 at example.com", "well... at example.com"])
def test_plain_prose_is_left_alone(text):
    assert pii.spans(text) == []


@pytest.mark.parametrize("text", ["a dot " * 30_000, "a-at-" * 30_000, " " * 200_000 + "[", "a at " * 30_000, "a.b at c." * 20_000, "one " * 40_000 + "x", "a-dot-" * 30_000 + "at-b"])
def test_long_disguises_take_linear_time(text):
    began = time.monotonic()
    pii.spans(text)
    assert time.monotonic() - began < 20


def test_pii_query(spark):
    rows = corpus(6) + odd_rows() + [(2000, "a@b.co 10.0.0.1 x [at] y [dot] com, a@b.co", "en", "h", 1)]
    got = pii.report(with_clashes(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    base = "email:0:6,email:36:42,ip:7:15"
    (hit,) = [r for r in got if r.doc_id == 2000]
    assert hit.spans == "email:0:6,email:16:34,email:36:42,ip:7:15"
    assert (hit.n_email, hit.n_ip, hit.n_card, hit.n_phone) == (3, 1, 0, 0)
    assert hit.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    (none,) = [r for r in got if r.doc_id == 1000]
    assert none.spans == "" and none.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.report(documents(spark, [])).collect() == []


# ---- quality ---------------------------------------------------------------
def brute_score(model, raw):
    """One window at a time, over chunks of two segments."""
    padded = bytes(quality.WIDTH - 1) + raw
    n = -(-len(padded) // quality.SEGMENT)
    padded += bytes(n * quality.SEGMENT + quality.WIDTH - len(padded))
    respond = [sum(model.tables[o, padded[p + o]].astype(float) for o in range(quality.WIDTH)) for p in range(n * quality.SEGMENT)]
    chunks = [(i, min(i + 1, n - 1)) for i in range(max(n - 1, 1))]
    features = [
        np.maximum(np.max(respond[a * quality.SEGMENT : (a + 1) * quality.SEGMENT] + respond[b * quality.SEGMENT : (b + 1) * quality.SEGMENT], axis=0) + model.bias, 0)
        for a, b in chunks
    ]
    return 1 / (1 + np.exp(-(np.mean(features, axis=0) @ model.weights + model.intercept)))


def test_scores_against_brute_force():
    rng = np.random.default_rng(1)
    shape = (quality.WIDTH, 256, quality.FILTERS)
    model = quality.Model(rng.normal(size=shape).astype(np.float32), rng.normal(size=quality.FILTERS), rng.normal(size=quality.FILTERS), 0.3)
    raw = [b"", b"a", bytes(rng.integers(0, 256, 700, dtype=np.uint8)), b"x" * quality.SEGMENT, b"hello world" * 30]
    assert np.allclose(quality.scores(model, raw), [brute_score(model, r) for r in raw], atol=1e-5)


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    shape = (quality.WIDTH, 256, quality.FILTERS)
    model = quality.Model(rng.normal(size=shape), np.full(quality.FILTERS, 0.1), rng.normal(size=quality.FILTERS), 0.1)
    raw, label = [b"some text " * 40, b"other!!"], np.array([1.0, 0.0])

    def loss(m):
        s = quality.scores(m, raw)
        return -np.mean(label * np.log(s) + (1 - label) * np.log(1 - s))

    grads = quality._gradients(model, raw, label)
    for at in [(0, ord("s"), 0), (2, ord("e"), 3), (4, ord("!"), 5)]:
        up, down = model.tables.copy(), model.tables.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        slope = (loss(model._replace(tables=up)) - loss(model._replace(tables=down))) / 2e-5
        assert abs(slope - grads[0][at]) < 1e-6
    slope = (loss(model._replace(intercept=0.1 + 1e-5)) - loss(model._replace(intercept=0.1 - 1e-5))) / 2e-5
    assert abs(slope - grads[3]) < 1e-6


def test_quality_query(spark):
    rng = random.Random(9)
    rows = [(i, sentence(rng, "en", 60) if i % 3 else "!! " + sentence(rng, "en", 40).upper().replace(" ", "!! "), "en", "h", 0) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(with_clashes(documents(spark, rows + odd_rows())), labels).collect()
    assert len(got) == 240 + len(odd_rows())
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 240]) > 0.97
    assert {r.score for r in got if r.doc_id == 1000} == {r.score for r in got if r.doc_id == 1001}


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.classify(documents(spark, [(1, "text", "en", "h", 4)]), none).collect()] == [0.5]
    assert quality.classify(documents(spark, []), none).collect() == []


def test_languages_above_the_bound_are_an_error(spark):
    rows = [(i, "some words", f"l{i % 5}", "host0", 0) for i in range(20)]
    assert langid.train(documents(spark, rows), max_languages=5).languages == ("l0", "l1", "l2", "l3", "l4")
    with pytest.raises(ValueError, match="more than 4 languages"):
        langid.train(documents(spark, rows), max_languages=4)
    rows = [(i, "some words", f"l{i}", "host0", 0) for i in range(257)]
    with pytest.raises(ValueError, match="more than 256 languages"):
        langid.train(documents(spark, rows))


def test_quality_sample_takes_long_texts_within_its_bytes(spark):
    rows = [(i, ("word " * (40_000 if i % 10 == 0 else 20)) + str(i), "en", "h", 0) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(120)], "doc_id long, quality int")
    seen = []
    original = quality.fit
    try:
        quality.fit = lambda texts, y: seen.append(texts) or original(texts[:8], y[:8])
        quality.train(documents(spark, rows), labels)
        quality.train(documents(spark, rows), labels, sample_bytes=500_000)
    finally:
        quality.fit = original
    assert len(seen[0]) == 120 and sum(len(t) > 16_384 for t in seen[0]) == 12
    assert 500_000 <= sum(map(len, seen[1])) <= 500_000 + 200_010 and len(seen[1]) < 120
    assert quality._last_point([], 5) == -1 and quality._last_point([(3, 9), (5, 1)], 1) == 3
