from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from klipgrid.llm import language as G
from klipgrid.llm import packing as P
from klipgrid.llm import plainform as N
from klipgrid.llm import queries as Q
from klipgrid.llm import repetition as R
from klipgrid.llm import splits as S
from klipgrid.llm import tokens as K
from klipgrid.llm.caps import CapState, cap_contributors
from klipgrid.llm.cutoffs import fraction_cutoffs

from conftest import DATA, compare


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_same_as_sql(spark, name):
    compare(spark, Q.QUERIES[name], Q.SQL[name])


@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p3_found", "p6_found", "p7_check", "p8_decoded"])
def test_same_as_sql_under_production_plans(production, name):
    compare(production, Q.QUERIES[name], Q.SQL[name])


# 1: cutoffs


def test_cutoffs(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, float("nan"), *[round(rnd.random(), 1) for _ in range(6)]]), i) for i in range(300)]
    data += data[:40] + [("c", 0.5, 0), ("d", None, 0)]
    df = spark.createDataFrame(data, "source string, score double, _n int")
    goal = spark.createDataFrame([("a", 650), ("b", 0), ("c", 1000), ("d", 500), ("z", 500), (None, 5), ("b", None)], "source string, keep int")
    got = {r["source"]: (r["cutoff"], r["n_kept"]) for r in fraction_cutoffs(df, "source", "score", goal, "keep").collect()}
    for s, permille in (("a", 650), ("b", 0), ("c", 1000)):
        scores = [x for k, x, _ in {(k, None if x is None or x != x else x, i) for k, x, i in data} if k == s and x is not None]
        want = max(t for t in scores if sum(x >= t for x in scores) * 1000 >= permille * len(scores))
        assert got[s] == (want, sum(x >= want for x in scores))
    assert set(got) == {"a", "b", "c"}
    assert fraction_cutoffs(df.where("false"), "source", "score", goal, "keep").count() == 0


# 2: repetition


def brute_share(text):
    words = [w for w in (R._DROP.sub("", t).casefold() for t in (text or "").split()) if w]
    hit, seen = set(), set()
    for i in range(len(words) - 2):
        if tuple(words[i : i + 3]) in seen:
            hit |= {i, i + 1, i + 2}
        seen.add(tuple(words[i : i + 3]))
    return len(hit) / len(words) if words else 0.0


TEXTS = [None, "", " \n ", "... !!", "a b c a b c", "A, b c! a b C", "a a a a", "a b c d e f a b c g", "x " * 30_000, "one two three four five", "a b c\n\na b c\nd"]


def test_repeated_share(spark):
    rnd = random.Random(2)
    texts = TEXTS + [" ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 40))) for _ in range(80)]
    # equal without letter case in one way of folding only; letters that an older Unicode doesn't have
    texts += ["Straße STRASSE strasse x " * 3, "ΑΣ ας ασ " * 2, "İ i̇ I ı k " * 3, "\U0001e4d0 \U0001e4d1 \U0001e4d0 " * 3, "a\x1cb\x85c\u3000a\xa0b c", "a-b ab A.B! c ab"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id int, text string, top_1 int")
    want = [brute_share(t) for t in texts]
    got = {r["id"]: r["share"] for r in R.exact_shares(df, ["id"], "text").collect()}
    assert all(abs(got[i] - x) < 1e-12 for i, x in enumerate(want))
    # the counts bound the share
    for r in R.counted(df, ["id"], "text").collect():
        assert r["low_3"] - 1e-9 <= want[r["id"]] <= min(r[c] for c in R.ABOVE) + 1e-9, texts[r["id"]]
    over = {i for i, x in enumerate(want) if x >= 0.4}
    found = lambda **x: {r["id"] for r in R.flag_repetitive(df, ["id"], "text", **x).collect()}
    assert found() == over
    # fitted on a few rows only, or not at all, it still misses none and invents none
    assert found(sample_rows=10) == over == found(rules=R.DecisionList([]))
    # a rule that is wrong doesn't lose anything either
    assert found(rules=R.DecisionList([([("n_words", ">=", 1.0)], "clean"), ([("top_2", "<=", 0.9)], "clean")])) == over
    assert R.flag_repetitive(df.where("false"), ["id"], "text").count() == 0


def test_the_list_decides_which_texts_are_walked_through(spark):
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randint(0, 400)}" for _ in range(60)) for _ in range(150)] + ["so it goes on and " * rnd.randint(3, 9) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rules = R.learn(df, ["id"], "text", 0.4, 1000)
    n = {r["verdict"]: r["count"] for r in R.judged(df, ["id"], "text", rules).groupBy("verdict").count().collect()}
    assert n["clean"] >= 140 and n["repetitive"] >= 35 and n.get("unsure", 0) <= 15
    assert {r["verdict"] for r in R.judged(df, ["id"], "text", R.DecisionList([])).collect()} == {"unsure"}


def test_decision_list_learns_conjunctions(spark):
    rnd = np.random.default_rng(3)
    x = rnd.random((600, 3))
    y = np.where((x[:, 0] > 0.6) & (x[:, 2] < 0.5), "bad", "good")
    rules = R.DecisionList.fit(x, y, ["p", "q", "r"])
    df = spark.createDataFrame([(*map(float, v), str(k)) for v, k in zip(x, y)], "p double, q double, r double, k string").withColumn("got", rules.column("unsure"))
    n = Counter((r["k"], r["got"]) for r in df.collect())
    assert n["bad", "good"] == n["good", "bad"] == 0 and n["bad", "bad"] > 100 and n["good", "good"] > 200


# 3: splits


def brute_components(edges):
    at = {}

    def find(x):
        while at.setdefault(x, x) != x:
            x = at[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        at[max(x, y)] = min(x, y)
    return {x: find(x) for x in at}


def test_components(spark):
    rnd = random.Random(4)
    path = list(range(100, 140))
    edges = [tuple(sorted(rnd.sample(range(40), 2))) for _ in range(25)] + list(zip(path, path[1:])) + [(200, i) for i in range(201, 215)]
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == brute_components(edges)


def test_subset_sums_are_closest():
    rnd = random.Random(5)
    for _ in range(60):
        sizes = {rnd.randint(1, 12): rnd.randint(1, 4) for _ in range(4)}
        flat = [s for s, m in sizes.items() for _ in range(m)]
        target = rnd.randint(0, sum(flat))
        reach = {0}
        for s in flat:
            reach |= {r + s for r in reach}
        took = S.choose_counts(sizes, target)
        assert all(n <= sizes[s] for s, n in took.items())
        assert abs(sum(s * n for s, n in took.items()) - target) == min(abs(r - target) for r in reach)
    assert abs(sum(s * n for s, n in S.choose_counts({3: 4000, 1: 50}, 9000, max_bits=512).items()) - 9000) == 0


def test_related_records_stay_together(spark):
    rnd = random.Random(6)
    data = [(f"v{rnd.randint(0, 150)}", rnd.choice([None, *[f"c{i}" for i in range(60)]])) for _ in range(220)] + [(None, "c1"), ("v0", None), ("v1", "c9"), ("v1", "c9")]
    df = spark.createDataFrame(data, "id string, channel string").withColumn("split", F.lit("x")).withColumn("root", F.lit(1))
    got = {r["id"]: r["split"] for r in S.related_splits(df, "id", "channel", {"train": 800, "valid": 100, "test": 100}).collect()}
    assert set(got) == {v for v, _ in data if v}
    by = defaultdict(set)
    for v, c in data:
        if v and c:
            by[c].add(got[v])
    assert all(len(s) == 1 for s in by.values())
    pairs = rows(S.related_pairs(df, "channel", "id"))
    comp = brute_components([(a, b) for a, b in {(x[1], y[1]) for x in data for y in data if x[0] and x[0] == y[0] and x[1] and y[1] and x[1] < y[1]}])
    assert pairs == sorted((a, b) for a in comp for b in comp if a < b and comp[a] == comp[b])
    assert S.related_splits(df.where("false"), "id", "channel", {"a": 500, "b": 500}).count() == 0


# 6: caps


@pytest.mark.parametrize(("cap", "batches"), [(1, 1), (3, 3), (500, 2)])
def test_caps(spark, tmp_path, cap, batches):
    rnd = random.Random(7)
    data = [(i, rnd.choice(["hot", "hot", "hot", "a", "b", None]), rnd.choice([None, 0.1, 0.2, rnd.random()]), 1) for i in range(160)]
    df = spark.createDataFrame(data, "id int, who string, score double, _beyond int")
    state = cap_contributors(df, "who", [("score", True), ("id", False)], cap, F.pmod("id", F.lit(batches)), batches, f"{tmp_path}/s")
    out = [r["id"] for r in state.log().collect()]
    want = left_out(data, cap)
    assert sorted(out) == sorted(want)
    assert {r["id"] for r in state.kept.collect()} == {r[0] for r in data if r[1]} - want
    assert "_beyond" in state.kept.columns


def left_out(data, cap):
    want = set()
    for w in ("hot", "a", "b"):
        ranked = sorted((r for r in data if r[1] == w), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        want |= {r[0] for r in ranked[cap:]}
    return want


def test_caps_go_on_in_another_session(spark, tmp_path):
    rnd = random.Random(8)
    data = [(i, "a" if i < 40 else rnd.choice(["hot", "hot", "b"]), rnd.choice([None, rnd.random()])) for i in range(120)]
    kind, path = "id int, who string, score double", f"{tmp_path}/s"
    other = spark.newSession()
    CapState.create(other, path, "who", [("score", True), ("id", False)], 5).add(other.createDataFrame(data[:60], kind))
    # a batch that fails before its state file is there leaves nothing behind
    (tmp_path / "s" / "admitted" / "v=2").mkdir()
    state = CapState.open(spark, path)
    assert state.version == 1
    state.add(spark.createDataFrame(data[60:], kind))
    again = CapState.open(spark.newSession(), path)
    assert again.version == 2 and {r["id"] for r in again.kept.collect()} == {r[0] for r in data} - left_out(data, 5)
    # "a" has no record in the second batch, so its cutoff isn't written again
    assert {r["_who"] for r in spark.read.parquet(f"{path}/cutoffs/v=2").collect()} == {"hot", "b"}
    assert {r["id"] for r in CapState.open(spark, path, 1).kept.collect()} == {r[0] for r in data[:60]} - left_out(data[:60], 5)
    assert {r["id"] for r in again.log(1).collect()} | {r["id"] for r in again.log(2).collect()} == left_out(data, 5)
    with pytest.raises(FileExistsError):
        CapState.create(spark, path, "who", [], 1)
    with pytest.raises(FileNotFoundError):
        CapState.open(spark, f"{tmp_path}/none")


def test_caps_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id int, who string, score double")
    state = cap_contributors(df, "who", [("score", True), ("id", False)], 2, F.lit(0), 1, f"{tmp_path}/s")
    assert state.log().count() == state.kept.count() == state.cutoffs.count() == 0


# 7: plain forms

WORDS = ["আর", "আমরা", "করে", "হয়েছে", "ভবিষ্যৎ", "café-তে", "TV-র", "অতঃপর", "গুলো"]


def test_plain_forms(spark):
    form = N.PlainForms(WORDS)
    for odd, plain in [
        ("আর", "আর"), ("আব়।", "আর।"), ("অামরা", "আমরা"), ("​করে\xa0", "করে"), ("হয়েছে৷", "হয়েছে।"), ("ভবিষ্যত্‍", "ভবিষ্যৎ"), ("сafé‐তে，", "café-তে,"), ("ＴＶ-র", "TV-র"),
        ("অত:পর", "অতঃপর"), ("গুল⁠ে­া", "গুলো"), ("", ""), (None, None), ("​", ""), ("Привет", "Привет"), ("nеw", "new"), ("১০:৩০", "১০:৩০"), ("লাল", "লাল"), ("করে।।", "করে।।"),
    ]:
        assert form(odd) == plain, odd
    # not look-alikes: letters that the vocabulary has are never exchanged
    assert N.PlainForms(["আকাশ", "আশ"]).match("আকশ") is None
    df = spark.createDataFrame([("আব়", "আর", 1), (None, None, 2), ("x" * 50_000, "", 3)], "word string, label string, word_plain int")
    got = rows(N.add_plain_forms(df, N.word_forms(WORDS)).select("word_plain", "label_plain").fillna("-"))
    assert got == sorted([("আর", "আর"), ("-", "-"), ("x" * 50_000, "")])
    assert N.add_plain_forms(df.where("false"), N.word_forms([])).count() == 0


def test_the_automaton_finds_what_the_table_cannot(spark):
    words = ["video-র", "TV", "গান", "গানটি", "কাক", "কাজ"]
    form, bare = N.PlainForms(words), N.PlainForms([])
    # a word wholly in another script's letters; a letter that no table knows; one that stands for nothing
    for odd, plain in [("ТѴ", None), ("𐍄V", "TV"), ("গ‎ান", "গান"), ("গाন", "গান"), ("vid𐌴o-র", "video-র"), ("গ\u200bা\u00adন", "গান")]:
        assert form(odd) == (plain or form(odd)), odd
    missed = [odd for odd in ("𐍄V", "গाন", "vid𐌴o-র") if bare(odd) != form(odd)]
    assert len(missed) == 3
    # two words are as near as each other: none is taken
    assert form.match("কাᬓ") is None
    # beyond the budget
    assert form.match("গ𐍄𐍄𐍄টি") is None
    # plain words stay as they are, in the vocabulary or not
    for w in [*words, "গান।", "নান", "কান", "TVs", "গান3", "TVé"]:
        assert form(w) == w, w


# 8: tokens


def test_ids_for_any_chunk(spark):
    rnd = random.Random(8)
    odd = [None, "", " ", "\n\n", "<|endoftext|>", "a  b\n\n\n c", "x" * 3000, "আমি ভাত খাই। " * 200, "'s's's " * 80, "\x1c\x1d a 　b  c", "🎬" * 300, " " * 500 + "a", "don't  stop\r\n" * 90]
    odd += ["".join(rnd.choice(["a", "ব", " ", "  ", "\n", "1", "'s", "!", "অা", "é"]) for _ in range(rnd.randint(0, 700))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(odd)], "id long, text string, k int")
    coder = K.encoder(K.FOLDER, "byte_bpe_50k")
    want = {i: coder.coding.encode_ordinary(t or "") for i, t in enumerate(odd)}
    for chunk, overlap, spread in ((K.CHUNK, K.OVERLAP, None), (64, 16, None), (64, 16, 100), (7, 3, None)):
        got = {r["id"]: r["ids"] for r in K.encode_corpus(df, "id", "text", chunk=chunk, overlap=overlap, spread=spread).collect()}
        assert got == want, (chunk, spread)
    for spread in (None, 100):
        n = {r["id"]: r["n_tokens"] for r in K.count_tokens(df, "id", "text", chunk=64, overlap=16, spread=spread).collect()}
        assert n == {i: len(x) for i, x in want.items()}
    back = K.decode_corpus(spark.createDataFrame([*want.items(), (-1, None)], "id long, ids array<int>"), "id", "ids")
    assert {r["id"]: r["text"] for r in back.collect()} == {-1: None, **{i: t or "" for i, t in enumerate(odd)}}
    assert back.where("false").count() == 0
    assert K.encode_corpus(df.where("false"), "id", "text").count() == 0


# 9: containers


def check_pack(items, got, capacity):
    load, parts = Counter(), defaultdict(list)
    for k, _, a, b, box in got:
        load[box] += b - a
        parts[k].append((a, b))
    assert max(load.values(), default=0) <= capacity
    for k, n in items.items():
        at = 0
        for a, b in sorted(parts[k]):
            assert a == at
            at = b
        assert at == n and (len(parts[k]) == 1 or n > capacity)
        assert sum(b - a < capacity for a, b in parts[k]) <= 1
    assert set(parts) == set(items)
    used = {box for box, n in load.items() if n}
    assert used == set(range(len(used))) or not used
    return len(used)


@pytest.mark.parametrize("kind", ["mixed", "small", "large", "one", "none"])
def test_packing(spark, kind):
    rnd = random.Random(9)
    make = {"mixed": lambda: rnd.choice([0, 100, 200, rnd.randint(1, 260), rnd.randint(1, 20)]), "small": lambda: rnd.randint(1, 11), "large": lambda: rnd.randint(40, 100), "one": lambda: 60, "none": lambda: 0}[kind]
    items = {i: make() for i in range(0 if kind == "none" else 300)}
    df = spark.createDataFrame([(k, n, 5) for k, n in items.items()] or [], "id long, n long, piece int")
    got = [tuple(r) for r in P.pack(df, "id", "n", 100, groups=12).select("id", "piece", "first", "last", "container").collect()]
    used = check_pack(items, got, 100)
    if kind in ("mixed", "small"):
        assert used <= 1.04 * sum(items.values()) / 100 + 2


def test_plans_come_near_their_bound():
    rnd = random.Random(10)
    for _ in range(20):
        sizes = sorted(rnd.sample(range(13, 101), 12), reverse=True)
        demand = [rnd.randint(1, 400) for _ in sizes]
        plan, bound = P.optimise(sizes, demand, 100)
        held = sum((p * n for p, n in plan), np.zeros(12, int))
        assert (held >= demand).all() and all(p @ np.array(sizes) <= 100 for p, _ in plan)
        assert -(-sum(s * n for s, n in zip(sizes, demand)) // 100) <= bound <= sum(n for _, n in plan) <= bound + 12
    assert P.optimise([], [], 100) == ([], 0)


# 10: languages


def _samples():
    import pyarrow.parquet as pq

    return [(r["lang"], r["sample"]) for r in pq.read_table(f"{DATA}/lang_samples.parquet").to_pylist()]


def read_whole(model, text):
    counts, sums = G.Reader(model).runs(text)
    return model.langs[int(model.by_language(sums.sum(axis=0)).argmax())]


def test_held_out_sentences():
    s = _samples()
    model = G.WordModel([x for i, x in enumerate(s) if i % 4])
    test = [x for i, x in enumerate(s) if i % 4 == 0]
    assert sum(read_whole(model, text) == lang for lang, text in test) / len(test) >= 0.97


def test_confidence_is_calibrated_on_held_out_sentences():
    tried = G.trials(_samples())
    weight, damp = G.tempered(tried)
    assert weight < 1 and G.calibration_error(tried, weight, damp) < 0.02
    assert len({round(c, 4) for _, c, _ in G._confidences(tried, weight, damp)}) > 20
    assert G.tempered([]) == (1.0, 0.0)


def test_runs_hold_all_evidence():
    s = _samples()
    model = G.WordModel(s)
    by = defaultdict(list)
    for lang, text in s:
        by[lang].append(text)
    text = " ".join(by["en"][:3] + by["hi"][:2] + ["x" * 300] + by["es"][:3])
    reader = G.Reader(model)
    counts, sums = reader.runs(text)
    scores = reader.scores(text)
    assert counts.sum() == len(scores) and np.allclose(sums.sum(axis=0), scores.sum(axis=0))
    assert scores.min() >= -G.STRAY - 0.001 and scores.max() == 0
    got = [model.langs[int(p.argmax())] for _, _, p in G.Fuser(model).passages(counts, sums, np.zeros(len(model.langs)))]
    assert got == ["en", "hi", "es"]
    assert G.Fuser(model).passages(*reader.runs(None), np.zeros(len(model.langs))) == []


def test_only_the_address_or_the_label_tells(spark):
    # two languages that share a sentence; it is in the one that its address, or its label, speaks for
    shared, own = "one two three four five six", {"a": "alpha beta gamma delta omega sigma", "b": "uno dos tres cuatro cinco seis"}
    samples = spark.createDataFrame([(x, t) for x in "ab" for t in (shared, own[x], own[x])], "lang string, sample string")
    site = {"a": "https://x.example/a", "b": "https://y.example/b"}
    docs = [(i, own[x], None, site[x]) for i, x in enumerate("ab" * 30)]
    docs += [(100, shared, None, site["a"]), (101, shared, None, site["b"]), (102, shared, None, "https://x.example/new"), (103, shared, None, "https://y.example/new")]
    kind = "id long, text string, label string, url string"
    got = {r["id"]: r for r in G.detect_passages(spark.createDataFrame(docs, kind), "id", "text", "label", "url", samples).collect()}
    assert [got[i]["lang"] for i in range(100, 104)] == ["a", "b", "a", "b"]
    assert 0.5 < got[102]["confidence"] < got[100]["confidence"] < 1 and len(got) == len(docs)
    docs = [(i, own[x], x.upper(), None) for i, x in enumerate("ab" * 30)] + [(100, shared, "A", None), (101, shared, "B", None)]
    got = {r["id"]: r["lang"] for r in G.detect_passages(spark.createDataFrame(docs, kind), "id", "text", "label", "url", samples).collect()}
    assert [got[i] for i in (100, 101)] == ["a", "b"]


def test_priors_move_a_border():
    model = G.WordModel([("a", "one two three four five"), ("b", "one two three four five"), ("a", "alpha beta gamma delta"), ("b", "uno dos tres cuatro"), ("c", "red green blue black")])
    fuser, sums = G.Fuser(model, passage=1), np.array([[-20.0, -20.0, 0.0], [0.0, -0.5, -20.0], [-20.0, -20.0, 0.0]])
    names = lambda prior: [model.langs[int(p.argmax())] for _, _, p in fuser.passages(np.array([5, 5, 5]), sums, np.log(prior))]
    assert [v[0] for v in model.variants] == ["a", "b", "c"]
    assert names([0.4, 0.2, 0.4]) == ["c", "a", "c"] and names([0.05, 0.55, 0.4]) == ["c", "b", "c"]


def test_passages_and_cases(spark):
    s = defaultdict(list)
    for lang, text in _samples():
        s[lang].append(text)
    latin = next(x for x in s["bn"] if x.isascii())
    docs = [
        (1, s["bn"][0], "bn"), (2, s["bn"][0], "en"), (3, s["en"][0] + " " + s["hi"][1], "en"), (4, None, None), (5, "", "xx"), (6, "https://a.example/b 00:10 <b> 🎬", None), (7, s["ur"][0], "  "),
        (8, s["es"][3] + " sound check " + s["es"][4], "es"), (9, latin, "bn"), (10, (s["as"][2] + "\n") * 800, "as"), (11, "sound check", "en"), (12, s["en"][2], None),
    ]
    df = spark.createDataFrame([(*d, "https://v.example/c", 1, "y") for d in docs], "doc_id long, text string, lang string, source string, n int, guess string")
    samples = spark.createDataFrame(_samples(), "lang string, sample string")
    codes = spark.createDataFrame([(x, x) for x in ("bn", "en", "hi", "ur", "es", "as")] + [(None, "en")], "code string, lang string")
    found = G.detect_passages(df, "doc_id", "text", "lang", "source", samples)
    assert all(0 < r["confidence"] <= 1 and r["n"] >= 5 for r in found.collect())
    assert rows(G.label_cases(found, "doc_id", codes)) == [(2, "bn"), (3, "en"), (3, "hi"), (7, "ur"), (12, "en")]
    assert G.detect_passages(df.where("false"), "doc_id", "text", "lang", "source", samples).count() == 0
    assert G.detect_passages(df, "doc_id", "text", "lang", "source", samples.where("false")).count() == 0
