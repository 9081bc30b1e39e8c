"""Each operator against brute force on small tables, and on odd ones."""

import base64
import hashlib
import random
import sys
import time
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chartloom.llm import chroma, decontamination, fm_index, graph, langid, packing, repeats, simhash, suffix_array, toxicity, url_reputation, warc
from chartloom.llm.common import shared_dir

rng = random.Random(5)
WORDS = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(40)]


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


SHARED = prose(40)
TEXTS = [prose(120), SHARED, prose(30) + " " + SHARED + " " + prose(30), None, "", "   ", SHARED, prose(3000) + SHARED, "a" * 300, "a" * 200 + "b", prose(20) + "\t" + SHARED.upper(), SHARED.replace(" ", "  ", 3)]
DOCS = [(i, t) for i, t in enumerate(TEXTS)] + [(1, SHARED), (7, TEXTS[7]), (None, SHARED), (None, None)]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture
def small(monkeypatch):
    for name, size in (("CHUNK_BYTES", 4000), ("ANCHOR_BYTES", 6000), ("RECORD_BYTES", 3000)):
        monkeypatch.setattr(repeats, name, size)


def with_clashes(docs, *names):
    """Other columns: two of one name, and some named like results."""
    out = docs
    for n in names:
        out = out.withColumn(n, F.lit("x"))
    return out.withColumn("_c0", F.lit(1)).withColumn("chunk", F.lit(2)).select("*", F.lit(3).alias("_c0"))


def removed(split, length, join):
    rank = lambda i: float("inf") if i is None else i
    rows, least, out = [(i, split((t or "").encode())) for i, t in DOCS], {}, []
    for i, x in rows:
        for p in range(len(x) - length + 1):
            k = tuple(x[p : p + length])
            least[k] = min(least.get(k, float("inf")), rank(i))
    for i, x in rows:
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - length + 1):
            if least[tuple(x[p : p + length])] < rank(i):
                gone[p : p + length] = True
        runs = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((i, len(x), int(gone.sum()), runs, hashlib.sha256(join([y for y, g in zip(x, gone, strict=True) if not g])).hexdigest()))
    return sorted(out, key=str)


def test_op1_is_exact(docs, small):
    got = suffix_array.digest(suffix_array.suffix_array_dedup(docs)).collect()
    assert sorted((tuple(r) for r in got), key=str) == removed(list, 50, bytes)


def test_op4_is_exact(docs, small):
    got = fm_index.digest(fm_index.fm_index_dedup(docs)).collect()
    want = [(i, n, m, s) for i, n, m, _, s in removed(bytes.split, 13, b" ".join)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def twins():
    """Words of 1024 letters whose hash modulo 2**64 is the same, whatever the odd base."""
    one = "a"
    while len(one) < 1024:
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_equal_hashes_are_no_equal_words(spark):
    a, b = twins()
    lead = " ".join(WORDS[:12])
    docs = spark.createDataFrame([(1, f"{lead} {a}"), (2, f"{lead} {b}"), (3, f"{lead} {a}")], SCHEMA)
    assert {r["doc_id"]: r["n_removed"] for r in fm_index.digest(fm_index.fm_index_dedup(docs)).collect()} == {1: 0, 2: 0, 3: 13}


def test_hashes_only_propose_equal_texts(docs, small, monkeypatch):
    monkeypatch.setattr(repeats, "range_hash", lambda c, start, end, own=repeats.range_hash: own(c, start, end) & np.uint64(0xFF00FF))
    test_op1_is_exact(docs, None)
    test_op4_is_exact(docs, None)


def test_bucket_refinement_and_backward_search():
    data = np.frombuffer(b"abracadabra" * 20 + b"abracadabrx" * 9, np.uint8)
    room = len(data) - np.arange(len(data))
    bucket = suffix_array.suffix_buckets(data, room, 50)
    at = np.flatnonzero(room >= 50)
    by = defaultdict(set)
    for p in at.tolist():
        by[data[p : p + 50].tobytes()].add(int(bucket[p]))
    assert all(len(v) == 1 for v in by.values())
    assert len({next(iter(v)) for v in by.values()}) == len(by)
    words = np.array([rng.randint(0, 5) for _ in range(400)])
    index = fm_index.FMIndex(words, np.array([20] * 20), 6)
    for n in (1, 2, 3):
        for _ in range(20):
            p = [rng.randint(0, 5) for _ in range(n)]
            want = sum(words[r * 20 + i : r * 20 + i + n].tolist() == p for r in range(20) for i in range(21 - n))
            assert index.count(p) == want


def brute_fingerprint(text, n=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), seed=42) for i in range(len(w) - n + 1)] or [xxhash.xxh64_intdigest(b" ".join(w), seed=42)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_op5_equals_brute_force(spark, docs):
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.digest(simhash.simhash_components(docs)).collect()}
    ids = sorted({i for i, _ in DOCS if i is not None})
    fp = defaultdict(set)
    for i, t in DOCS:
        fp[i].add(brute_fingerprint(t))
    parent = {i: i for i in ids}
    for _ in ids:
        for i in ids:
            for j in ids:
                if any((a ^ b).bit_count() <= 2 for a in fp[i] for b in fp[j]):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    assert got == {(i, f"{brute_fingerprint(t):016x}", parent.get(i)) for i, t in DOCS}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_covering_masks_cover(radius):
    for family in (0, 1):
        masks = simhash.covering_masks(radius, family)
        for _ in range(300):
            places = rng.sample(range(64), radius)
            assert any(all(not m >> p & 1 for p in places) for m in masks)


@pytest.mark.parametrize("bucket", [4096, 3])
def test_links_lose_no_component(spark, bucket):
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base:
        x = b
        for _ in range(6):
            x ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    distinct = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    links = [(r["x"], r["y"]) for r in simhash.fingerprint_links(distinct, 2, bucket).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in links)
    parent = {simhash.signed(x): simhash.signed(x) for x in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[root(a)] = root(b)
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 2:
                assert root(simhash.signed(a)) == root(simhash.signed(b))


def test_large_buckets_by_lookup():
    members = np.unique(np.array([rng.getrandbits(12) << 20 for _ in range(900)], np.uint64))
    links = list(simhash.linked(members, 2))
    assert len(members) > 512 and len(links) == len(members) - 1  # twelve free places: all connected


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(5, 5)]
    got = {tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 130)}


LANGS = {"x": [f"{a}{b}ka" for a in "abcdefgh" for b in "lmnop"], "y": [f"tz{a}{b}" for a in "äöüqrst" for b in "vwxyz"]}


def test_op6_learns_and_handles_odd_texts(spark):
    rows = [(i, " ".join(rng.choice(LANGS[lang]) for _ in range(30)) + "!!", lang) for i, lang in enumerate(["x", "y"] * 60)]
    rows += [(1000, None, "x"), (1001, "", None), (1002, "12 34 ...", "y"), (1003, "tzäv " * 5000, None), (1004, "½ ② ① Ⅷ", "y"), (None, "alka blka", "x"), (3, rows[3][1], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("old")).withColumn("_c1", F.lit(1))
    got = langid.cross_parse_language(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == lang for i, _, lang in rows[:120])
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(120))
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, 1004)] == ["und", "und", "und", "y", "und"]
    assert all(0 <= r["score"] <= 1 for r in got) and by[1000]["score"] == 0
    none = langid.cross_parse_language(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r[0] for r in none] == ["und"]


def test_op6_prediction_equals_plain_parsing():
    texts = {lang: " " + " ".join(words) + " " for lang, words in LANGS.items()}
    own = langid.Parser(texts)

    def phrases(known, s):
        n = i = 0
        while i < len(s):
            k = 0
            while i + k < len(s) and s[i : i + k + 1] in known:
                k += 1
            i, n = i + max(k, 1), n + 1
        return n

    for _ in range(40):
        t = " ".join(rng.choice(LANGS["x"] + LANGS["y"]) + rng.choice(["", "!", "9q"]) for _ in range(12))
        runs = [r for w in t.lower().split() for r in langid.LETTERS.findall(w)]
        cost = {lang: sum(phrases(known, f" {r} ") for r in runs) * np.log2(len(known) + 1) for lang, known in texts.items()}
        lang, score = own.predict(t)
        assert lang == min(cost, key=lambda x: (cost[x], x)) and score == pytest.approx(1 - min(cost.values()) / max(cost.values()))


def test_op6_walks_runs_of_many_texts_together(monkeypatch):
    """Distinct words cost no walk of their own, but long runs and characters without a column; results do not depend on it."""
    texts = {lang: " " + " ".join(words) + " " for lang, words in LANGS.items()} | {"z": " " + " ".join(chr(0x4E00 + i) for i in range(300)) + " "}
    own, walked, phrases = langid.Parser(texts), [], langid.SuffixAutomaton.phrases
    monkeypatch.setattr(langid.SuffixAutomaton, "phrases", lambda self, run: walked.append(run) or phrases(self, run))
    some = [" ".join("".join(rng.choice("abckläöztz") for _ in range(rng.randint(1, 12))) + rng.choice(["", "!", "9q"]) for _ in range(40)) for _ in range(50)]
    together = own.predict_all(some)
    assert not walked
    odd = ["a" * 200 + " tzäv", "".join(chr(0x4E00 + i) for i in range(290, 320)), None, "", "12 !", "ΑΣ ΑΣΑ"]
    both = own.predict_all(odd)
    assert walked
    monkeypatch.setattr(langid, "LONG_RUN", 0)  # every run by itself
    assert own.predict_all(some) == together and own.predict_all(odd) == both
    monkeypatch.setattr(langid, "SLICE", 7)
    assert own.predict_all(some + odd) == together + both
    assert [x[0] for x in both[2:5]] == ["und"] * 3


def test_op6_ties_go_to_the_first_language():
    assert langid.Parser({"a": " same ", "b": " same "}).predict("same")[0] == "a"


def test_suffix_automaton_counts_phrases():
    text = "".join(rng.choice("abc") for _ in range(200))
    a = langid.SuffixAutomaton(text)
    for _ in range(50):
        s, n, i = "".join(rng.choice("abcd") for _ in range(20)), 0, 0
        while i < len(s):
            k = 0
            while i + k < len(s) and s[i : i + k + 1] in text:
                k += 1
            i, n = i + max(k, 1), n + 1
        assert a.phrases(s) == n


def test_op2_learns_and_folds(spark):
    bad = ["vilex", "grubby", "snarkle"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = [rng.choice(WORDS) for _ in range(36)] + [rng.choice(bad if toxic else WORDS) for _ in range(4)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(9001, "V1L3X grubb\u0443 " + " ".join(WORDS)), (9002, None), (9003, ""), (None, "vilex"), (9004, WORDS[0] + " " + WORDS[1]), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("label", F.lit(2))
    labels = spark.createDataFrame([*labels, (None, 1), (5, None), (0, 0)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [r for i, r in got.items() if i is not None and i < 600 and r["held_out"]]
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in held]) > 0.97
    assert got[9001]["score"] > 0.5 > got[9004]["score"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[9002]["score"] == got[9003]["score"]
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} < {0.0, 1.0} or max(r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()) < 1e-9


def test_exception_phrases_excuse_hits():
    lexicon = toxicity.Lexicon(((" vile ", 3.0),), (" not vile ",), (1.0, 0.0, 0.0, 0.0, 0.0))
    assert toxicity.measures(lexicon, "not vile")[1] == 0 < toxicity.measures(lexicon, "so vile")[1]
    assert toxicity.folded("V\u0456L\u00c9 5tuff") == ["vile", "stuff"]
    assert toxicity.folded("2024 10 $ 5 % h3ll0 a@b") == ["2024", "10", "5", "hello", "aab"]


def plain_measures(lexicon, text):
    """The same sums by trying every entry at every place."""
    line = f" {' '.join(toxicity.folded(text))} "
    places = lambda entry: [i for i in range(len(line)) if line.startswith(entry, i)]
    excused = [(i, i + len(x)) for x in lexicon.exceptions for i in places(x)]
    best = {}
    for entry, weight in lexicon.entries:
        for i in places(entry):
            if not any(a <= i and i + len(entry) <= b for a, b in excused):
                best[i] = max(best.get(i, 0.0), weight)
    total, n = sum(best.values()), len(line.split())
    return total / np.sqrt(n + 10.0), np.log1p(total), max(best.values(), default=0.0), np.log1p(n)


def test_measures_equal_a_naive_matcher():
    entries = tuple(sorted({(f" {w} ", float(i + 1)) for i, w in enumerate(WORDS[:12])} | {(f" {w[:5]}", 2.5) for w in WORDS if len(w) > 5}))
    lexicon = toxicity.Lexicon(entries, tuple(sorted({f" {a} {b} " for a in WORDS[:6] for b in WORDS[6:12]})), (1.0,) * 5)
    for n in (0, 1, 5, 50, 400):
        t = prose(n)
        assert np.allclose(toxicity.measures(lexicon, t), plain_measures(lexicon, t))


def test_excuses_are_linear_in_the_text():
    lexicon = toxicity.Lexicon(((" vile ", 3.0),), (" not vile ",), (1.0, 0.0, 0.0, 0.0, 0.0))
    began = time.time()
    assert toxicity.measures(lexicon, "not vile vile " * 300_000)[1] == pytest.approx(np.log1p(3.0 * 300_000))
    assert time.time() - began < 20


def test_log_odds_equal_a_plain_count(spark):
    texts = [(f"{WORDS[i % 7]} {WORDS[i % 5]} {WORDS[i % 3]}", i % 2) for i in range(60)]
    rows = spark.createDataFrame(texts, "text string, label int")
    got = {r["feature"]: (r["toxic"], r["clean"], r["w"]) for r in toxicity.counted(rows, toxicity.features_of).withColumn("w", toxicity.log_odds(30, 30)).collect()}
    want = defaultdict(lambda: [0, 0])
    for t, label in texts:
        for f in toxicity.features_of(toxicity.folded(t)):
            want[f][label] += 1
    assert {k: v[:2] for k, v in got.items()} == {k: (v[1], v[0]) for k, v in want.items()}
    assert all(w == pytest.approx(np.log((a + 0.5) / 31) - np.log((b + 0.5) / 31)) for a, b, w in got.values())


def test_op3_round_trip(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = [*DOCS, (500, "word " * 9000), (501, "a<|endoftext|>b")]
    got = packing.best_fit_pack(spark.createDataFrame(rows, SCHEMA).withColumn("offset", F.lit("x"))).collect()
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    want = []
    for i, t in rows:
        ids = np.array([*encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cut = [0] + list(range(len(ids) % 2048 or 2048, len(ids) + 1, 2048))
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False))]
    assert sorted((tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == [0, *np.cumsum([n for _, n in sorted(b)])[:-1]] and sum(n for _, n in b) <= 2048
    assert len(bins) == -(-sum(r["length"] for r in got) // 2048)


def searched(lengths, capacity):
    """Numbers of bins: best fit, after the search, lower bound."""
    first = packing.best_fit(lengths, capacity)
    then = packing.local_search([list(b) for b in first], lengths, capacity)
    assert sorted(i for b in then for i in b) == list(range(len(lengths)))
    assert all(lengths[b].sum() <= capacity for b in then)
    return len(first), len(then), packing.fewest(lengths, capacity)


@pytest.mark.parametrize("seed", [16, 31])
def test_local_search_strictly_beats_best_fit(seed):
    r = np.random.default_rng(seed)
    first, then, bound = searched(r.integers(20, 51, r.integers(10, 60)), 100)
    assert bound <= then < first


@pytest.mark.parametrize("seed", range(40))
def test_search_stays_between_the_bound_and_best_fit(seed):
    r = np.random.default_rng(seed)
    first, then, bound = searched(r.integers(1, 51, 8), 50)
    assert bound <= then <= first


def fewest_by_trying(lengths, capacity):
    best, loads = [len(lengths)], []

    def place(i):
        if len(loads) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(loads)
            return
        for b in range(len(loads)):
            if loads[b] + lengths[i] <= capacity:
                loads[b] += lengths[i]
                place(i + 1)
                loads[b] -= lengths[i]
        loads.append(lengths[i])
        place(i + 1)
        loads.pop()

    place(0)
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_lower_bound_never_exceeds_the_optimum(seed):
    lengths = np.random.default_rng(seed).integers(1, 21, 8)
    assert packing.fewest(lengths, 20) <= fewest_by_trying(sorted(lengths.tolist(), reverse=True), 20)


def test_packing_without_gain_ends_at_once():
    r = np.random.default_rng(0)
    began = time.time()
    assert searched(r.integers(1030, 1401, 50_000), 2048)[1] == 50_000
    assert searched(np.concatenate([np.full(300, 1500), np.ones(20_000, int)]), 2048)[1] == 300
    assert time.time() - began < 10


def test_fast_reader_agrees_with_the_tokenizer(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    slow = Tokenizer.from_file(path)
    for t in [t for t in TEXTS if t] + ["  \n\t x  ", "日本語 😀 naïve", "don't 1234567 !!", "a" * 5000]:
        assert packing.token_ids(t, path).tolist() == slow.encode(t, add_special_tokens=False).ids


PAGES = [(3, "https://User@A.Example.com:80/x?q#f", "<p>one</p>"), (1, "http://b.org", "<p>one</p>"), (2, None, None), (4, "no scheme", ""), (5, "http://b.org/ü\r\nX: y", "é" * 5000), (1, "http://b.org", "<p>one</p>"), (None, "http://c.net", "<p>one</p>")]


def test_op7_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("segment", F.lit("x")).withColumn("digest", F.lit(1))
    archive = warc.write_archive(pages)
    got = sorted((tuple(r) for r in warc.read_archive(archive).drop("url").collect()), key=str)
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = [(3, 10, digest("<p>one</p>"), "revisit", 1), (1, 10, digest("<p>one</p>"), "response", None), (1, 10, digest("<p>one</p>"), "revisit", 1), (2, 0, digest(""), "response", None), (4, 0, digest(""), "revisit", 2), (5, 10000, digest("é" * 5000), "response", None), (None, 10, digest("<p>one</p>"), "response", None)]
    assert got == sorted(want, key=str)
    assert sorted(r["page_id"] for r in warc.lookup(archive, ["http://b.org", "http://none"]).collect()) == [1, 1]
    assert sorted((tuple(r) for r in warc.lookup(archive, pages).drop("url").collect()), key=str) == got
    assert warc.surt("https://User@A.Example.com:80/x?q#f") == "com,example,a)/x?q"
    data = archive.segments.first()["data"]
    assert [raw[:8] for _, raw in warc.records_in(bytes(data))][0] == b"WARC/1.1"


def test_op7_looks_up_through_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 3)
    monkeypatch.setattr(warc, "CUTS", 8)
    rows = [(i, f"http://h{i % 37}.org/{i % 5}" if i % 3 else "http://hot.org/", f"<p>{i % 50}</p>") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc.write_archive(pages)
    assert 1 <= len(warc.sections_of(archive.directory)) <= 8
    assert sorted(r["page_id"] for r in warc.lookup(archive, pages).collect()) == list(range(400))
    some = ["http://hot.org/", "http://h7.org/2", "http://h1.org/none", None]
    assert sorted(r["page_id"] for r in warc.lookup(archive, some).collect()) == [i for i, u, _ in rows if u in some]


def test_op7_small_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "v", "ab"), (3, "w", "abcdef"), (4, "x", "abcdef")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.read_archive(warc.write_archive(pages, least=5)).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_op7_archive_is_not_moved_to_be_read(spark, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 1 << 16)
    rows = [(i, f"http://h{i % 37}.org/{i}", base64.b64encode(random.Random(i).randbytes(6000)).decode()) for i in range(300)]
    archive = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    size = archive.segments.agg(F.sum(F.octet_length("data")).alias("n")).first()["n"]
    assert size > 300 * 6000 and archive.segments.count() > 20

    def shuffled():
        context = spark.sparkContext._jsc.sc()
        context.listenerBus().waitUntilEmpty()
        told = context.statusStore().executorList(False)
        return sum(told.apply(i).totalShuffleWrite() for i in range(told.size()))

    for found in (warc.lookup(archive, [u for _, u, _ in rows]), warc.read_archive(archive)):
        before = shuffled()
        assert sorted((r["page_id"], r["payload_digest"]) for r in found.collect()) == [(i, warc.digest_of(t.encode())) for i, _, t in rows]
        assert shuffled() - before < size / 4
    assert not [t.name for t in spark.catalog.listTables("spark_catalog.default") if t.name.startswith("warc_")]


def test_op8_finds_copies_and_leaves_others(spark):
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    items = [some(rng.randint(15, 55)) for _ in range(30)]
    long = some(150)
    docs, want = [], set()
    for i in range(200):
        body = some(rng.randint(50, 300))
        if i % 4 == 0:
            j = i // 4 % 30
            copy = [w if rng.random() > 0.1 else rng.choice(words) for w in items[j]] if i % 8 else list(items[j])
            at = rng.randint(0, len(body))
            body[at:at] = copy
            want.add((i, j))
        docs.append((i, " ".join(body).capitalize() + "."))
    docs += [(300, " ".join(some(40) + long + some(40))), (301, None), (302, ""), (0, docs[0][1]), (None, docs[4][1])]
    bench = [(j, " ".join(x)) for j, x in enumerate(items)] + [(77, " ".join(long)), (78, None), (79, "too few words"), (None, "")]
    d = spark.createDataFrame(docs, SCHEMA).withColumn("item_id", F.lit(1))
    b = spark.createDataFrame(bench, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = [(r["doc_id"], r["item_id"]) for r in decontamination.latent_decontamination(d, b).collect()]
    assert len(want & set(got)) >= 0.95 * len(want)
    assert set(got) <= want | {(300, 77), (None, 1)}
    assert (300, 77) in got and got.count((0, 0)) == 2
    assert decontamination.latent_decontamination(d.limit(0), b).count() == 0
    assert decontamination.latent_decontamination(d, b.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 3, 7, 8, 10, 12, 14, 20])
def test_op8_finds_short_items(spark, n):
    r = random.Random(n)
    words = [f"v{i}" for i in range(3000)]
    docs, want = [], set()
    items = [r.sample(words, n) for _ in range(20)]
    background = [f"u{i}" for i in range(3000)]
    for i in range(120):
        body = r.choices(background, k=r.randint(60, 200))
        if i % 2:
            copy = list(items[i // 2 % 20])
            if n >= 8 and i % 4 == 1:
                for k in r.sample(range(n), n // 5):
                    copy[k] = "other"
            at = r.randint(0, len(body))
            body[at:at] = copy
            want.add((i, i // 2 % 20))
        docs.append((i, " ".join(body)))
    bench = spark.createDataFrame([(j, " ".join(x)) for j, x in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontamination.latent_decontamination(spark.createDataFrame(docs, SCHEMA), bench).collect()}
    assert want <= got if n > 1 else want == got


def test_op8_searches_every_text_of_an_id(spark):
    r = random.Random(8)
    some = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    texts = [some(30) for _ in range(6)]
    docs = spark.createDataFrame([(i, f"{some(60)} {t} {some(60)}") for i, t in enumerate(texts)] + [(9, some(150))], SCHEMA)
    bench = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[2]), (None, texts[3]), (None, texts[4]), (None, texts[5])], "item_id long, text string")
    got = sorted(((x["doc_id"], x["item_id"]) for x in decontamination.latent_decontamination(docs, bench).collect()))
    assert got == [(0, 1), (1, 1), (2, 2), (3, None), (4, None), (5, None)]


def test_op8_fits_on_every_document(spark, monkeypatch):
    """Basis and frequencies come from all rows, null ids and those beyond any number included."""
    docs = spark.createDataFrame([(None if i % 50 == 0 else i, f"w{i} w{i % 7} of a text") for i in range(4200)], SCHEMA)
    items, counts, summed = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string"), [], decontamination.summed

    def spied(rows, *rest):
        counts.append(rows.count())
        return summed(rows, *rest)

    monkeypatch.setattr(decontamination, "summed", spied)
    assert decontamination.latent_decontamination(docs, items).count() == 0
    assert sorted(counts) == [1, 4200, 4200]


def test_op8_recalls_what_all_windows_find(spark):
    """Copies with a part of the words replaced: the latent vectors' candidates against every window with every passage."""
    gen = random.Random(8)
    text = lambda n: " ".join(f"w{int(3000 * gen.random() ** 3)}" for _ in range(n))
    items = [(i, text(gen.randrange(26, 90))) for i in range(40)]
    rows = [(i, text(200)) for i in range(400)]
    for i in range(200):
        words = items[i % 40][1].split()
        for j in gen.sample(range(len(words)), int(len(words) * gen.choice([0, 0.1, 0.2, 0.3]))):
            words[j] = f"x{gen.randrange(10**6)}"
        rows.append((1000 + i, f"{text(gen.randrange(40))} {' '.join(words)} {text(60)}"))
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    of = lambda **kw: {(r["doc_id"], r["item_id"]) for r in decontamination.latent_decontamination(docs, bench, **kw).collect()}
    every = of(cosine=-1.1)
    found = of()
    assert len(every) > 100 and found <= every
    assert len(found) >= 0.9 * len(every), (len(found), len(every))


def test_op8_looks_at_all_regions_together():
    """Candidates cost no step of their own unless they hold enough of the passage's words, which plain counting confirms."""
    gen = random.Random(18)
    text = lambda n, of: " ".join(f"{of}{gen.randrange(60)}" for _ in range(n))
    table = np.random.default_rng(8).standard_normal((decontamination.FEATURES + 1, 4)).astype(np.float32)
    passages = decontamination.passages_of([(i, text(gen.choice([10, 22, 40, 48, 90]), "w")) for i in range(30)], table)
    values, first = decontamination.word_hashes([text(300, gen.choice("wx")) for _ in range(20)] + ["", None])
    begin = np.array([gen.randrange(len(values)) for _ in range(3000)])
    end = np.minimum(len(values), begin + [gen.randrange(129) for _ in begin])
    passage = np.array([gen.randrange(len(passages.words)) for _ in begin])
    held = decontamination.words_held(values, begin, end, passage, passages)
    for a, b, p, n in zip(begin, end, passage, held, strict=True):
        there = set(values[a:b].tolist())
        assert n == sum(w in there for w in passages.words[p])

    texts, steps = [text(800, "x") for _ in range(8)], []
    sys.setprofile(lambda *event: steps.append(event[1]))
    try:
        found = list(decontamination.verified(texts, table, passages, -1.1))
    finally:
        sys.setprofile(None)
    assert not found and len(steps) < 8 * 50 * len(passages.words) / 2  # a half of the windows


def test_common_subsequence():
    for _ in range(50):
        a, b = [rng.randint(0, 4) for _ in range(rng.randint(0, 12))], [rng.randint(0, 4) for _ in range(rng.randint(0, 12))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontamination.common_subsequence(tuple(a), b) == t[-1][-1]


def test_op9_aligns_shifted_and_noisy_recordings(spark):
    r = np.random.default_rng(3)
    tunes = [r.normal(size=80).tolist() for _ in range(12)]
    rows = [(i * 50, t) for i, t in enumerate(tunes)]
    rows += [(1, tunes[0]), (2, tunes[1][10:]), (3, [x + 1e-4 for x in tunes[2]]), (4, None), (5, []), (6, [float("nan")]), (7, [1.0]), (None, tunes[0]), (50, tunes[1])]
    media = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("prints", F.lit(1))
    got = chroma.align(media, "vec_id", "embedding", chroma.melody).collect()
    assert len(got) == len(rows)
    by = {x["id"]: x for x in got}
    assert by[1]["class_id"] == 0 and by[4]["class_id"] == 4 and by[4]["n_prints"] == 0 and by[None]["class_id"] is None
    found = {(i, m["class_id"]): m["shift"] for i, x in by.items() if x["matches"] for m in x["matches"]}
    assert found[50, 2] == 20  # ten notes of two hops each
    assert all(pair in {(50, 2), (100, 3)} for pair in found)
    assert by[1]["links"] is None and by[0]["links"] == 0


def test_op9_reads_wav_and_forgives_noise():
    import io
    import wave

    samples, rate = chroma.melody(np.random.default_rng(1).normal(size=60).tolist())
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1), f.setsampwidth(2), f.setframerate(rate)
        f.writeframes((samples * 20000).astype("<i2").tobytes())
    read, got_rate = chroma.wav_samples(out.getvalue())
    a, b = chroma.prints(samples, rate), chroma.prints(read + np.random.default_rng(2).normal(0, 600, len(read)), got_rate)
    assert np.bitwise_count(a ^ b).sum() / (32 * len(a)) < 0.05


def noisy(x, rate, r):
    """Integers with each bit wrong at this rate."""
    return x ^ ((r.random((len(x), 32)) < rate) * (1 << np.arange(32, dtype=np.uint64))).sum(axis=1).astype(np.uint32)


def test_op9_recalls_what_brute_force_finds(spark, monkeypatch):
    r = np.random.default_rng(9)
    tunes = [chroma.prints(*chroma.melody(r.normal(size=64).tolist())) for _ in range(24)]
    clips = [(10_001 + 50 * i, noisy(t[: (24, 40, 70, 112)[i % 4]], (0.05, 0.1, 0.13)[i % 3], r)) for i, t in enumerate(tunes)]
    every = [(50 * i, t) for i, t in enumerate(tunes)] + clips
    want = set()
    for q, a in every[:24]:
        for c, b in every:
            if q != c and any(n >= 24 and e <= 0.15 for n, e in (chroma.overlapping(a, b, s) for s in range(24 - len(b), len(a) - 23))):
                want.add((q, c))
    assert len(want) >= 20
    given = lambda media, *_: media.select("id", F.col("x").alias("prints"))
    monkeypatch.setattr(chroma, "fingerprints", given)
    media = spark.createDataFrame([(i, bytearray(x.astype("<u4").tobytes())) for i, x in every], "id long, x binary")
    got = {(row["id"], m["class_id"]) for row in chroma.align(media, "id", "x").collect() for m in row["matches"] or []}
    assert got <= want and len(got) >= 0.9 * len(want)


def test_op10_rules_and_reputation(spark):
    rows = [(1, "https://es.EXAMPLE.org/es/a?x#y"), (2, "http://example.org/en/12"), (3, "http://example.org/en/2"), (4, "http://x.com/de/"), (5, "http://notexample.org"), (6, None), (7, "nothing"), (8, "a://b://c/d"), (9, "http://x.com/fr")]
    rows += [(100 + i, f"http://bad.spam.net/{i}") for i in range(40)] + [(200 + i, f"http://h{i % 7}.fine.net/{i}") for i in range(60)]
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string").withColumn("n", F.lit(1)).withColumn("verdict", F.lit("x"))
    outcomes = spark.createDataFrame([(100 + i, 1) for i in range(40)] + [(200 + i, 0) for i in range(60)] + [(None, 1), (4, None)], "id long, bad int")
    got = {r["page_id"]: r for r in url_reputation.judge(pages, outcomes).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(1, 10)] == [
        ("es.example.org", "/es/a", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "/en/2", "org/", "allow"), ("x.com", "/de/", "com/de/", "block"),
        ("notexample.org", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("b:", "//c/d", None, "allow"), ("x.com", "/fr", None, "allow"),
    ]
    assert got[100]["verdict"] == "block" and got[200]["verdict"] == "allow"
    assert url_reputation.judge(pages, outcomes.limit(0)).where("verdict = 'block' AND rule IS NULL").count() == 0


def test_op10_equals_its_sql(spark, tmp_path):
    import duckdb

    pages = [(i, f"http{'s' * (i % 2)}://h{i % 9}.d{i % 4}.{'net' if i % 3 else 'org'}/{'es' if i % 5 else 'en'}/{i}") for i in range(300)]
    labels = [(i, i % 3 > 0, i % 7 == 0) for i in range(0, 300, 2)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", [(a, int(b), int(c)) for a, b, c in labels])
    outcomes = spark.createDataFrame([(a, int(not b or c)) for a, b, c in labels], "id long, bad int")
    got = url_reputation.judge(spark.createDataFrame(pages, "page_id long, url string"), outcomes).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, con.sql(url_reputation.oracle()).fetchall()))


EMPTY = {
    "op1": lambda d: suffix_array.suffix_array_dedup(d), "op2": lambda d: toxicity.toxicity(d, d.sparkSession.createDataFrame([], "doc_id long, toxic int")), "op3": lambda d: packing.best_fit_pack(d),
    "op4": lambda d: fm_index.fm_index_dedup(d), "op5": lambda d: simhash.simhash_components(d), "op6": lambda d: langid.cross_parse_language(d.withColumn("lang", F.lit("x"))),
    "op7": lambda d: warc.read_archive(warc.write_archive(d.toDF("page_id", "html").withColumn("url", F.lit("u")))), "op9": lambda d: chroma.align(d, "doc_id", "text", lambda x: (np.zeros(0), 1)),
    "op10": lambda d: url_reputation.judge(d.toDF("page_id", "url"), d.sparkSession.createDataFrame([], "id long, bad int")),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_tables(spark, name):
    assert EMPTY[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(("operator", "results"), [(suffix_array.suffix_array_dedup, ("n_bytes", "spans", "kept", "kept_text")), (fm_index.fm_index_dedup, ("n_words", "word_spans", "kept")), (packing.best_fit_pack, ("piece", "start", "sequence_id", "offset"))])
def test_other_columns_pass_and_clashing_ones_give_way(docs, operator, results):
    out = operator(with_clashes(docs, *results))
    assert out.columns.count("_c0") == 2 and "chunk" in out.columns and all(out.columns.count(r) == 1 for r in results)
    assert out.select("doc_id", *results).count() >= len(DOCS)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    context = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda _: None), getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context))
