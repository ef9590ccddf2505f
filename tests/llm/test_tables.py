"""Chat windows, line dedup, decontamination, embeddings, SimHash, components, WARC and the pipeline."""

from __future__ import annotations

import collections
import gzip
import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import bpe, catalogue, chat, decontaminate, embeddings, langid, linededup, simhash, warc
from larder.llm.components import components
from larder.sources.staging import settle
from tests.llm.fixtures import SF, corpus, documents, odd_rows, sentence, with_clashes

# ---- chat ------------------------------------------------------------------
CHAT = "conv_id long, turn long, role string, text string"
HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "a\\b <\\| <| [\\INST] \\\\", "<<SYS>>x<</SYS>>", "", "\n\n", "[|"]


def conversations(seed: int = 4) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(12):
        if c % 2:
            rows.append((c, 0, "system", sentence(rng, "en", 12)))
        for t in range(1, rng.choice([1, 2, 9, 40])):
            text = rng.choice([*HARD, sentence(rng, "en", rng.randint(1, 90)), None])
            rows.append((c, t, "assistant" if t % 2 == 0 else "user", text))
    rows += [(-7, 0, "user", HARD[0]), (-7, 1, "assistant", HARD[0]), (50, None, "user", "no number"), (50, 0, "assistant", "yes")]
    rows += [(51, 0, "assistant", "twice"), (51, 0, "assistant", "twice"), (52, 0, None, None), (53, 3, "odd\nrole <|", "text")]
    rows += [(54, 0, "system", "alone"), (55, 0, "assistant", sentence(rng, "en", 900)), (None, 1, "user", "lost"), (None, 2, "assistant", "found")]
    return rows


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_reads_back_whole(spark):
    rows = conversations()
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append((-1 if t is None else t, role or "", text or ""))
    windows = chat.windows(spark.createDataFrame(rows, CHAT).withColumn("at", F.lit(1)).withColumn("system", F.lit("x")), budget=160, history=60, min_span=40)
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    assert set(got) == set(turns)
    for c, listed in turns.items():
        listed.sort()
        loss = "".join(t for _, r, t in listed if r == "assistant")
        assert got[c].n_turns == len(listed)
        assert got[c].turns_sha256 == digest("".join(f"{r}\n{t}\n" for _, r, t in listed))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), digest(loss))
    assert chat.read_back(chat.windows(spark.createDataFrame([], CHAT))).collect() == []


def test_chat_windows_keep_budget_system_and_history(spark):
    budget, history = 160, 60
    rows = [r for r in conversations() if r[0] is not None and r[0] < 50]
    frame = chat.windows(spark.createDataFrame(rows, CHAT), budget=budget, history=history, min_span=40)
    windows = frame.select("*", chat.turns_of(F.col("formatted")).alias("turns")).collect()
    by_conv = collections.defaultdict(list)
    for w in sorted(windows, key=lambda w: (w.conv_id, w["at"])):
        by_conv[w.conv_id].append(w)
    assert max(map(len, by_conv.values())) > 3
    for c, own in by_conv.items():
        seen: list = []
        for n, w in enumerate(own):
            turns = [(t.role, t.text) for t in w.turns]
            fresh = turns[w.n_repeated :]
            assert w.n_turns == len(turns) and fresh
            if n and c % 2 and c > 0:
                assert turns[0] == seen[0] and turns[0][0] == "system"
            past = turns[:w.n_repeated]
            past = past[1:] if past and past[0][0] == "system" else past
            assert not past or past == seen[-len(past) :]
            assert w.n_tokens <= budget or len(fresh) == 1
            assert "".join(w.formatted[s.start : s.start + s.length] for s in w.loss).count("<|im_end|>") == 0
            assert len(w.loss) == sum(r == "assistant" for r, _ in fresh)
            seen += fresh
    repeated = sum(w.n_repeated for w in windows)
    assert repeated > len(windows) // 2


def test_chat_runs_without_python(spark):
    plan = catalogue.QUERIES["op1_chat"](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("text", HARD)
def test_escape_is_reversible(spark, text):
    frame = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t")).alias("e"))
    escaped, back = frame.select("e", chat.unescape(F.col("e"))).first()
    assert back == text and not any(x in escaped for x in ("<|", "</s>", "[INST]", "[/INST]", "<<SYS>>"))


# ---- line dedup ------------------------------------------------------------
def brute_lines(rows, ratio, min_pages):
    pages, on = collections.Counter(), collections.Counter()
    clean = lambda line: line.strip(" \t\r")
    for _, text, _, host, _ in rows:
        pages[host] += 1
        on.update({(host, clean(x)) for x in (text or "").split("\n") if clean(x)})
    gone = {k for k, n in on.items() if n >= min_pages and n > ratio * pages[k[0]]}
    out = []
    for doc_id, text, _, host, _ in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if not clean(x) or (host, clean(x)) not in gone]
        out.append((doc_id, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_line_dedup_against_brute_force(spark):
    rows = corpus(40) + odd_rows() + [(3000 + i, "only line\r\nnote", "en", None, 9) for i in range(6)]
    frame = with_clashes(documents(spark, rows))
    got = linededup.drop_boilerplate(frame, "source", ratio=0.3, min_pages=3)
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str) == brute_lines(rows, 0.3, 3)
    assert got.agg(F.sum("n_dropped")).first()[0] >= 22
    assert linededup.drop_boilerplate(documents(spark, []), "source").collect() == []


def test_line_dedup_counts_copies_once_on_request(spark):
    # a third of each source are copies of one text; on "a" a line is on 6 distinct pages, on "b" on 4 and their copies
    rng = random.Random(6)
    rows = []
    for host, n in (("a", 6), ("b", 4)):
        copied = "\n".join(sentence(rng, "en", 12) for _ in range(3)) + ("\nfooter" if host == "b" else "")
        for i in range(50):
            text = copied if i % 3 == 0 else sentence(rng, "en", 30) + f" {i}" + ("\nfooter" if i % 3 == 1 and i // 3 < n - (host == "b") else "")
            rows.append((len(rows), text, "en", host, len(text)))
    rows += [(200 + i, None, "en", "a", None) for i in range(80)]
    distinct = list({(r[1], r[3]): r for r in rows}.values())
    want = {(r[3], r[1]): text for r, text in zip(distinct, [x[1] for x in sorted(brute_lines([(i, *r[1:]) for i, r in enumerate(distinct)], 0.05, 5), key=lambda x: x[0])])}
    frame = documents(spark, rows)
    cleared = linededup.drop_boilerplate(frame, "source", copies_once=True)
    got = cleared.collect()
    assert {r.doc_id: r.text for r in got} == {r[0]: want[r[3], r[1]] for r in rows}
    assert sum(r.n_dropped for r in got) == 6
    texts = {r.text for r in simhash.representatives(cleared.where("text IS NOT NULL").drop("n_lines", "n_dropped")).collect()}
    assert {rows[0][1], rows[50][1]} <= texts and "" not in texts


def test_line_dedup_with_very_many_boilerplate_lines(spark):
    common = [f"line {i} of all" for i in range(3000)]
    rows = [(i, "\n".join([*common, f"own {i}", "\t" + common[i]]), "en", "a", 0) for i in range(12)] + [(20, "own 3\nline 7 of all", "en", "b", 0)]
    got = linededup.drop_boilerplate(documents(spark, rows), "source", copies_once=True).collect()
    assert {r.doc_id: (r.text, r.n_dropped) for r in got} == {**{i: (f"own {i}", 3001) for i in range(12)}, 20: ("own 3\nline 7 of all", 0)}


def test_clashing_names_come_back_as_they_were(spark):
    names = "__site __lines __kept __row __fp __clean __identified site lines left row fp clean identified FP Row".split()
    plain = documents(spark, corpus(30))
    names = [n for n in names if n.lower() not in {m.lower() for m in names[: names.index(n)]}]
    frame = plain.select("*", *(F.lit(f"extra {n}").alias(n) for n in names))
    model = langid.train(plain)
    none = spark.createDataFrame([(1, "not in any of them at all")], "item_id long, text string")
    for got in (
        linededup.drop_boilerplate(frame, "source").drop("n_lines", "n_dropped"),
        simhash.representatives(frame),
        decontaminate.drop_contaminated(frame, none),
        langid.keep_identified(frame, model, 0.5),
    ):
        assert got.columns == frame.columns
        assert {tuple(r)[5:] for r in got.collect()} == {tuple(f"extra {n}" for n in names)}
    found = decontaminate.find(plain.withColumnRenamed("doc_id", "item_id"), key="item_id", benchmark=plain.limit(1).select(F.col("doc_id").alias("item_id"), "text"))
    assert found.columns == ["item_id", "item_id_", "edits", "start", "end"] and found.count() >= 1
    assert decontaminate.find(plain.withColumnRenamed("doc_id", "edits"), none, key="edits").columns == ["edits", "item_id", "edits_", "start", "end"]


def test_line_dedup_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(catalogue.SQL["op2_linededup"]).fetchall())
    got = catalogue.QUERIES["op2_linededup"](spark, SF)
    assert sorted(map(tuple, got.collect())) == want
    assert not any(x in got._jdf.queryExecution().toString() for x in ("Python", "Pandas", "Arrow"))


def test_host_of_url(spark):
    rows = spark.createDataFrame([("https://www.A.example/x?y",), ("http://m.b.org:80/",), (None,)], "url string")
    assert [r[0] for r in rows.select(linededup.host_of(F.col("url"))).collect()] == ["a.example", "m.b.org", None]


# ---- decontamination -------------------------------------------------------
def edit_distance(a, b):
    """Least edits between a and any stretch of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, share):
    words = text.split()
    for _ in range(int(share * len(words))):
        kind, at = rng.random(), rng.randrange(len(words))
        if kind < 0.6:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind < 0.8:
            del words[at]
        else:
            words.insert(at, f"more{rng.randrange(10**6)}")
    return " ".join(words)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(6, 60)))) for i in range(40)]
    items += [(40, None), (41, ""), (42, "too short here"), (43, items[0][1])]
    rows = []
    for i in range(120):
        body = " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 120)))
        if i % 3:
            body += ". " + edited(rng, items[i % 40][1], rng.choice([0, 0.1, 0.2, 0.35])).upper() + "! " + " ".join(f"w{rng.randrange(400)}" for _ in range(9))
        rows.append((i, body, "en", "h", len(body)))
    rows += odd_rows()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    words = lambda t: decontaminate.words_of(t or "").hashes.tolist()
    for doc_id, text, *_ in rows[:120]:
        for item, passage in items:
            p = words(passage)
            if len(p) >= decontaminate.MIN_WORDS and edit_distance(p, words(text)) <= math.floor(0.2 * len(p) + 1e-9):
                want.add((doc_id, item, edit_distance(p, words(text))))
    frame = with_clashes(documents(spark, rows))
    found = decontaminate.find(frame, benchmark).collect()
    got = {(r.doc_id, r.item_id, r.edits) for r in found}
    exact = {w for w in want if w[2] == 0}
    assert len(want) > 60 and got <= want and exact <= got and len(got) >= 0.97 * len(want)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        place = words(texts[r.doc_id][r.start : r.end])
        assert edit_distance(words(dict(items)[r.item_id]), place) == r.edits
    blocks = decontaminate.find(frame, benchmark, block=7)
    assert {(r.doc_id, r.item_id, r.edits) for r in blocks.collect()} == got
    kept = decontaminate.drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in {g[0] for g in got})
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find(frame, none).collect() == [] and decontaminate.drop_contaminated(frame, none).count() == len(rows)
    assert decontaminate.find(documents(spark, []), benchmark).collect() == []


def test_decontamination_finds_edited_passages():
    rng = random.Random(2)
    items = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(35))) for i in range(150)]
    index = decontaminate.build(items)
    filler = " ".join(f"w{rng.randrange(300)}" for _ in range(50))
    hits = total = 0
    for share in (0.05, 0.1, 0.15):
        texts = [f"{filler} {edited(rng, t, share)} {filler}" for _, t in items]
        found = {(d, i) for d, i, *_ in decontaminate.search(index, texts)}
        hits += sum((i, i) in found for i in range(len(items)))
        total += len(items)
    assert hits / total >= 0.97


@pytest.mark.parametrize("size", [5, 9, 10, 14, 20, 50, 59, 95, 400])
def test_decontamination_finds_any_spacing_of_the_allowed_edits(size):
    rng = random.Random(size)
    words = [f"w{rng.randrange(300)}" for _ in range(size)]
    index = decontaminate.build([("item", " ".join(words))])
    most = size // 5
    step = -(-size // most)
    spacings = [[x for x in range(p, size, step)][:most] for p in range(step)]
    spacings += [list(range(0, size, 5))[:most], list(range(0, size, 6))[:most], list(range(most)), list(range(size - most, size))]
    spacings += [rng.sample(range(size), most) for _ in range(200)]
    filler = " ".join(f"v{rng.randrange(300)}" for _ in range(30))
    for places in spacings:
        for kind in ("replace", "delete", "insert"):
            new = [([f"x{i}"] if kind == "replace" else [] if kind == "delete" else [f"x{i}", w]) if i in places else [w] for i, w in enumerate(words)]
            text = " ".join([filler, *sum(new, []), filler])
            want = edit_distance(words, text.split())
            assert want <= most and [f[:3] for f in decontaminate.search(index, ["", text, filler])] == [(1, 0, want)], (places, kind)


@pytest.mark.parametrize(
    "item, text, edits",
    [
        ("Paris", "It is paris, I think", 0),
        ("forty two", "the answer: Forty-two!", 0),
        ("too short here", "not too short. Here", 0),
        ("too short here", "not too small here", None),
        ("two words", "one two word", None),
        ("我喜欢吃苹果，你呢？", "他说：我喜欢吃苹果你呢。", 0),
        ("我喜欢吃苹果，你呢？", "他说：我喜欢吃香果你呢。", 1),
        ("我喜欢吃苹果，你呢？", "他说：我不吃香果你呢。", None),
        ("東京はどこですか", "質問:東京はどこですか?", 0),
        ("ภาษาไทย", "เรียนภาษาไทยกัน", 0),
        ("x2線 test", "an X2 線 Test", 0),
    ],
)
def test_decontamination_finds_short_and_unspaced_items(item, text, edits):
    # words of another text on either side must not complete an item
    words = item.split()
    around = [words[0], text, words[-1]] if len(words) > 1 else ["nothing", text, ""]
    found = decontaminate.search(decontaminate.build([(0, "?!"), (1, item), (2, "")]), around)
    assert [f[:3] for f in found] == ([] if edits is None else [(1, 0, edits)])
    for _, _, _, start, end in found:
        assert text[start : end].strip() and start >= 0 and end <= len(text)


def test_decontamination_query_finds_planted_items(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    got = {(r.doc_id, r.item_id) for r in catalogue.QUERIES["op6_decontamination"](spark, SF).collect()}
    assert exact and exact == got


# ---- components and SimHash ------------------------------------------------
def brute_components(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    frame = spark.createDataFrame([*pairs, (7, 7), (1, 0), (None, 3)], "x long, y long")
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    want = brute_components(nodes, pairs)
    got = components(frame).collect()
    assert {(r.node, r.component) for r in got} == set(want.items()) and len(got) == len(want)
    assert components(frame.limit(0)).collect() == []


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [None, "", "one", "One two", "a b c", "A  b\tc\nd e f é Ü　x", "to be or not to be " * 9, "x y z " * 40_000]:
        assert simhash.fingerprint_of(text) == brute_fingerprint(text)


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_links_against_all_pairs(spark, distance):
    rng = random.Random(distance)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for base in list(prints):
        for flips in range(6):
            value = base
            for bit in rng.sample(range(64), flips):
                value ^= 1 << bit
            prints.add(value)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance}
    got = [(r.a, r.b) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), distance).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_links_never_broadcast_the_index(spark):
    prints = settle(spark.range(1000).select(F.xxhash64("id").alias("fp")), "prints")  # 8 KB for Spark, some 33,000 rows indexed
    plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def near_rows():
    rng = random.Random(12)
    base = [" ".join(f"t{rng.randrange(3000)}" for _ in range(400)) for _ in range(6)]
    rows = []
    for i in range(60):
        words = base[i % 6].split()
        if i % 4:
            words[rng.randrange(400)] = "changed"
        rows.append((i, " ".join(words), "en", "h", 0))
    return rows + odd_rows()


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows()
    prints = [brute_fingerprint(r[1]) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    groups = brute_components(range(len(rows)), pairs)
    least = {}
    for i, g in groups.items():
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    want = sorted((str(rows[i][0]), f"{prints[i]:016x}", str(least.get(groups[i]))) for i in range(len(rows)))
    frame = with_clashes(documents(spark, rows))
    got = simhash.near_duplicates(frame).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.representatives(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(least.get(g)) for g in set(groups.values()))
    assert simhash.near_duplicates(documents(spark, [])).collect() == [] and simhash.representatives(documents(spark, [])).collect() == []


# ---- embeddings ------------------------------------------------------------
def vectors():
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(14):
            rows.append((len(rows), (centre + rng.normal(size=16) * rng.choice([0.02, 0.12, 0.3])).tolist()))
    rows += [(len(rows) + i, rows[3][1]) for i in range(20)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [float("inf")] * 16), (905, [None] + [1.0] * 15)]
    rows += [(906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, rows[3][1]), (908, rows[3][1]), (908, rows[3][1]), (909, (np.array(rows[3][1]) * 1e-30).tolist())]
    return rows


def test_embeddings_against_brute_force(spark):
    rows = vectors()
    usable = lambda v: bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [np.array(v, np.float32).astype(float) if usable(v) else None for _, v in rows]
    unit = [v / np.linalg.norm(v) if v is not None else None for v in unit]
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95
    ]
    degree = collections.Counter(n for p in pairs for n in p)
    groups = brute_components(range(len(rows)), pairs)
    least = {}
    for i, g in groups.items():
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    want = sorted((str(rows[i][0]), degree[i], str(least[groups[i]])) for i in range(len(rows)))
    frame = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    for block, group in ((1024, 4096), (5, 16)):  # whole buckets, and buckets cut into blocks
        got = embeddings.near_duplicates(frame, block=block, group=group).collect()
        assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


def test_recall_of_the_tables():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    close = 0.95 * x + math.sqrt(1 - 0.95**2) * y
    for rows in (1000, 10**6):
        bits, tables = embeddings.tables_for(rows)
        met = (embeddings.sign_keys(x, bits, tables) == embeddings.sign_keys(close, bits, tables)).any(axis=1)
        assert met.mean() >= 0.99


# ---- WARC ------------------------------------------------------------------
def pages():
    big, other = "<p>é" + "x" * 1200, "y" * 1000
    return [
        (1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://b/\r\nX-Evil: 1", other), (5, "http://b/5", other),
        (6, "http://c/6", "small"), (7, "http://c/7", "small"), (8, "http://c/8", None), (9, "http://c/9", ""), (10, "u", "z" * 999),
        (11, "u", "z" * 999), (5, "http://b/5", other), (None, "n", other), (12, "v", "WARC/1.1\r\n\r\nWARC-Type: revisit\r\n\r\n" + "q" * 1000),
    ]


def read_warc(raw: bytes):
    """Records of a plain WARC file: header lines and block."""
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        yield fields, rest[:n]
        raw = rest[n + 4 :]


def test_warc_round_trip(spark, tmp_path):
    rows = pages()
    frame = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    path = str(tmp_path / "archive")
    warc.write(frame, path)
    store = spark.read.parquet(f"{path}/payloads").collect()
    assert len(store) == len({r[2] or "" for r in rows})
    assert all(hashlib.sha256(r.payload).hexdigest() == r.sha256 for r in store)
    largest = {}
    for page, _, html in rows:
        if html and len(html.encode()) >= 1000 and page is not None:
            largest[html] = max(largest.get(html, page), page)
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        first = largest.get(html)
        revisit = first is not None and page != first
        want.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(tuple, warc.catalogue(warc.read(spark, path)).collect()), key=str) == sorted(want, key=str)
    out = tmp_path / "files"
    warc.export(spark, path, str(out))
    records = [r for f in out.glob("part-*") for r in read_warc(f.read_bytes())]
    assert len(records) == len(rows)
    for fields, block in records:
        payload = block.split(b"\r\n\r\n", 1)[1]
        if fields["WARC-Type"] == "response":
            assert "sha1:" + hashlib.sha1(payload).hexdigest() == fields["WARC-Payload-Digest"]
        else:
            assert payload == b"" and fields["WARC-Refers-To"]
    for compression, buckets in ((None, None), ("gzip", None), ("gzip", 8)):
        files = str(tmp_path / f"{compression}{buckets}")
        warc.export(spark, path, files, compression, buckets)
        parsed = warc.parse(spark, files)
        assert sorted(map(tuple, warc.described(parsed).collect()), key=str) == sorted(want, key=str)
        whole = warc.reconstruct(parsed).collect()
        assert sorted(((r.page_id, r.payload) for r in whole), key=str) == sorted(((p, (h or "").encode()) for p, _, h in rows), key=str)
        assert all(r.digest == "sha1:" + hashlib.sha1(r.payload).hexdigest() for r in whole)
        assert {bytes(r.head) for r in whole} == {bytes(r["head"]) for r in warc.read(spark, path).collect()}
    empty = str(tmp_path / "empty")
    warc.write(frame.limit(0), empty)
    warc.export(spark, empty, f"{empty}/files")
    assert warc.described(warc.parse(spark, f"{empty}/files")).collect() == []
    assert warc.read(spark, empty).collect() == []


def test_warc_files_that_are_cut_are_an_error():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 5\r\n\r\na\r\n\r\n\r\n\r\n"
    assert [r[-1] for r in warc.records_of(record * 2)] == [b"", b""]
    assert [r[-1] for r in warc.records_of(gzip.compress(record) + gzip.compress(record * 2))] == [b""] * 3
    for bad in (record[:-1], record[:30], b"x" + record, record.replace(b": 5", b": 6"), gzip.compress(record)[:-12]):
        with pytest.raises(ValueError):
            list(warc.records_of(bad))


# ---- the pipeline ----------------------------------------------------------
def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(21)
    rows = corpus(48) + near_rows()
    item = " ".join(f"b{rng.randrange(500)}" for _ in range(30))
    rows += [(5000, sentence(rng, "en", 40) + " " + item + " " + sentence(rng, "en", 10), "en", "host0", 0)]
    rows += [(5001, "ελληνικά γράμματα μόνο εδώ", "en", "host0", 0)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    model = langid.train(documents(spark, rows).where(langid.remainder("doc_id", 4) != 2))
    names, scores, _ = langid.label(model, [r[1] for r in rows])
    left = [r for r, n, s in zip(rows, names, scores) if n != "und" and s >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    assert {r[0] for r in rows} - {r[0] for r in left} == {1000, 1001, 1002, 1005, 1006, 5001}
    ids = [r[0] for r in left]
    distinct = list(dict.fromkeys((r[1], r[3]) for r in left))  # copies on a host are one page
    once = brute_lines([(i, text, None, host, 0) for i, (text, host) in enumerate(distinct)], linededup.RATIO, linededup.MIN_PAGES)
    cleared = {distinct[place]: text for place, text, *_ in once}
    texts = [cleared[r[1], r[3]] for r in left]
    assert sum(len(t) for t in texts) < sum(len(r[1]) for r in left)
    prints = [brute_fingerprint(t) for t in texts]
    groups = brute_components(range(len(left)), [(i, j) for i in range(len(left)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    first = {}
    for i, g in groups.items():
        rank = (ids[i] is None, ids[i] or 0)
        if g not in first or rank < first[g][0]:
            first[g] = (rank, i)
    stay = [i for _, i in first.values() if item not in texts[i]]
    assert len(stay) == len(first) - 1
    codec = bpe.load(catalogue.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    import regex

    want = []
    for i in stay:
        tokens = [t for p in regex.findall(catalogue.public_tokenizers.PATTERN, texts[i]) for t in codec.encode_piece(p.encode())]
        want.append((str(ids[i]), len(tokens), hashlib.sha256(bpe.pack(tokens)).hexdigest(), digest(texts[i])))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_pipeline_keeps_documents_of_several_languages(spark):
    rng = random.Random(4)
    en, de, fr = (lambda n, x=x: sentence(rng, x, n) for x in ("en", "de", "fr"))
    mixed = [
        (901, "\n".join([en(40), de(30), fr(30)]), None, "host0", 0),
        (902, en(40) + "\n" + fr(40) + " ελληνικά γράμματα", None, "host0", 0),
        (903, en(2) + " ελληνικά γράμματα μόνο εδώ και εκεί", None, "host0", 0),
        (904, "1234", None, "host0", 0),
    ]
    docs = documents(spark, corpus(48) + mixed)
    model = langid.train(docs.where(langid.remainder("doc_id", 4) != 2))
    assert langid.label(model, [mixed[0][1]])[1][0] < 0.5
    kept = {r.doc_id for r in corpus_pipeline.identify(spark, docs, SF).collect()}
    assert kept == {*range(48), 901, 902}


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash", "decontamination", "bpe"]


def test_pipeline_of_no_documents(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", ["op7_embeddings", "op10_warc"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = catalogue.QUERIES[name](spark, SF)
    want = con.execute(catalogue.SQL[name]).fetchall()
    assert got.columns == [d[0] for d in con.description]
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
