import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from chartloom.llm import near_copies
from chartloom.llm.common import mix, written

rng = random.Random(5)
SCHEMA = "doc_id long, text string"


def text(n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def edited(t, n):
    words = t.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def jaccard(a, b):
    x, y = (near_copies.shingles((t or "").encode(), 5) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def test_fingerprint_equals_a_plain_majority():
    t = "One two three four five SIX seven one two three four five six".encode()
    w = t.lower().split()
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(w[i : i + 5]), seed=42) for i in range(len(w) - 4)], np.uint64)
    want = 0
    for j, salt in enumerate(near_copies.salts(3)):
        for bit in range(64):
            want |= (2 * sum(int(h) >> bit & 1 for h in mix(hashes ^ salt)) > len(hashes)) << (64 * j + bit)
    assert int.from_bytes(near_copies.wide_fingerprint(t, 5, 3), "little") == want
    assert near_copies.wide_fingerprint(b" \n", 5, 3) == bytes(24)


def test_groups_of_similar_texts_and_no_others(spark):
    base = [text(300) for _ in range(40)]
    rows = list(enumerate(base))
    rows += [(100 + i, edited(t, 2)) for i, t in enumerate(base[:20])]  # similarity over 0.9
    rows += [(200 + i, edited(t, 40)) for i, t in enumerate(base[20:])]  # similarity under 0.6
    rows += [(300 + i, base[0].upper()) for i in range(50)] + [(300, base[0].upper()), (None, base[0])]
    rows += [(400, None), (401, ""), (402, " \n"), (500, "so few"), (501, "So  few"), (502, "so many"), (600, text(60_000))]
    got = dict(map(tuple, near_copies.near_copies(spark.createDataFrame(rows, SCHEMA)).select("id", "group").distinct().collect()))
    want = {i: i for i, _ in rows} | {100 + i: i for i in range(20)} | {300 + i: 0 for i in range(50)} | {400: 400, 401: 400, 402: 400, 501: 500, None: None}
    assert all(jaccard(base[i], rows[40 + i][1]) > 0.9 for i in range(20)) and all(jaccard(base[20 + i], rows[60 + i][1]) < 0.6 for i in range(20))
    assert got == want


def test_links_are_as_similar_as_they_must_be(spark):
    base = [text(200) for _ in range(60)]
    rows = [(10 * i + k, edited(t, k)) for i, t in enumerate(base) for k in range(0, 10)]
    got = {r["id"]: r["group"] for r in near_copies.near_copies(spark.createDataFrame(rows, SCHEMA)).collect()}
    texts = dict(rows)
    assert all(i // 10 == g // 10 for i, g in got.items())
    for i, g in got.items():
        if i != g:
            assert any(jaccard(texts[i], texts[j]) >= 0.8 for j in got if j != i and got[j] == g)
    near = [i for i in got if i % 10 == 1]
    assert sum(got[i] != i for i in near) >= 0.9 * len(near)


def grouped(spark, rows):
    return dict(map(tuple, near_copies.near_copies(spark.createDataFrame(rows, SCHEMA)).select("id", "group").collect()))


def test_repeated_lines_count_once(spark):
    line = text(11)
    a, b, c = text(100), text(100), text(300)
    rows = [(i, " ".join([line] * n + [t])) for i, (n, t) in enumerate([(20, a), (20, b), (60, a + " x"), (60, b + " x")])]
    assert jaccard(rows[0][1], rows[1][1]) < 0.2
    rows += [(10, c), (11, " ".join([line] * 5 + [c]))]  # alike but for one line, five times
    assert jaccard(c, rows[-1][1]) > 0.8
    assert grouped(spark, rows) == {0: 0, 1: 1, 2: 0, 3: 1, 10: 10, 11: 10}


def test_pairs_under_a_template_are_compared(spark):
    base = text(400)
    rows = [(0, base)]
    for i in range(1, 60):
        ours = edited(base, 13)
        rows += [(10 * i, ours), (10 * i + 1, edited(ours, 4))]
    assert sum(jaccard(base, t) < 0.8 for _, t in rows) >= 100
    got = grouped(spark, rows)
    texts = dict(rows)
    assert all(got[10 * i + 1] == got[10 * i] for i in range(1, 60) if jaccard(texts[10 * i], texts[10 * i + 1]) >= 0.8)


def test_every_pair_at_the_limit_is_joined(spark):
    rows = []
    for i in range(60):
        t = text(300)
        rows += [(10 * i, t), (10 * i + 1, edited(t, 6))]
    texts = dict(rows)
    near = [i for i in range(0, 600, 10) if 0.8 <= jaccard(texts[i], texts[i + 1]) < 0.85]
    got = grouped(spark, rows)
    assert len(near) >= 10 and all(got[i + 1] == i for i in near)


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_buckets_come_whole_or_in_slices(batch):
    k = np.repeat(np.arange(12), [1, 2, 5, 1, 9, 1, 1, 3, 20, 1, 2, 1])
    rows = [pa.RecordBatch.from_arrays([pa.array(k[a : a + batch])], ["k"]) for a in range(0, len(k), batch)]
    seen, last = [], False
    for part, starts, goes_on in near_copies.runs(iter(rows), 6):
        keys = part.column(0).to_numpy()
        assert not seen or last or keys[0] != seen[-1]
        assert list(starts) == [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
        seen, last = seen + list(keys), goes_on
    assert seen == list(k) and not last


def test_large_buckets_keep_their_links(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "COMPARED", 4)
    t = text(400)
    rows = [(i, edited(t, 1)) for i in range(40)]
    got = near_copies.near_copies(spark.createDataFrame(rows, SCHEMA)).agg(F.max("group")).first()[0]
    assert got == 0


def test_empty_table_and_clashing_columns(spark):
    assert near_copies.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, "a b", "x", "y"), (2, "a b", "x", "y")], "doc_id long, text string, fp string, `group` string")
    assert {(r["id"], r["group"], r["stays"]) for r in near_copies.near_copies(odd).collect()} == {(1, 1, True), (2, 1, False)}


def test_texts_under_one_id_are_told_apart(spark):
    a, b, c = text(200), text(200), text(200)
    rows = [(1, a), (1, b), (2, a), (3, edited(b, 1)), (1, a), (4, c), (None, c)]
    got = near_copies.near_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    stay = {(r["id"], bytes(r["body"]).hex()) for r in got if r["stays"]}
    body = lambda t: __import__("hashlib").md5(t.encode()).hexdigest()
    assert stay == {(1, body(a)), (1, body(b)), (4, body(c)), (None, body(c))}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_groups_equal_those_of_all_pairs_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {r["doc_id"]: near_copies.shingles((r["text"] or "").encode(), 5) for r in docs.collect()}
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s or {b""}:
            having[x].append(i)
    common = Counter()
    for ids in having.values():
        common.update((a, b) for k, a in enumerate(sorted(ids)) for b in sorted(ids)[k + 1 :])
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if not sets[a] and not sets[b] or sets[a] and sets[b] and n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    want = {i: root(i) for i in sets}
    got = {r["id"]: r["group"] for r in near_copies.near_copies(docs).collect()}
    assert got == want and sum(i != g for i, g in want.items()) > 20


def test_pairs_that_are_not_similar_enough_are_no_rows(spark, monkeypatch):
    """Of texts of one template, near each other but under the limit, no step writes a table that grows with their pairs."""
    base, n = text(400), 300
    rows = [(i, edited(base, 7)) for i in range(n)]
    rows.append((n, edited(rows[5][1], 1)))
    sims = [jaccard(rows[i][1], rows[i + 1][1]) for i in range(n - 1)]
    assert all(0.6 < s < 0.8 for s in sims)
    made = {}

    def spied(df, label):
        out = written(df, label)
        made[label] = max(made.get(label, 0), out.count())
        return out

    monkeypatch.setattr(near_copies, "written", spied)
    got = grouped(spark, rows)
    texts = dict(rows)
    apart = [i for i in texts if all(jaccard(texts[i], t) < 0.8 for j, t in rows if j != i)]
    assert len(apart) > 0.9 * n and all(got[i] == i for i in apart)
    assert got[n] == got[5]
    assert max(made.values()) <= 100 * len(rows), made


def test_bucket_links_connect_what_may_be_similar(spark):
    """In small and large buckets, links connect the same members as all pairs do, one link a member at most."""
    width, most = near_copies.WIDTH, near_copies.farthest(0.8, near_copies.WIDTH)
    gen, rows, want = np.random.default_rng(3), [], set()
    for k, size in enumerate([1, 2, 3, 5, 9, 16, 17, 40, 90]):
        fps = gen.integers(0, 2**63, (4, width)).astype(np.uint64)[gen.integers(0, 4, size)]
        for _ in range(110):
            fps[np.arange(size), gen.integers(0, width, size)] ^= np.uint64(1) << gen.integers(0, 64, size).astype(np.uint64)
        n = gen.integers(90, 120, size)
        ids = 1000 * k + np.arange(size)
        rows += [(k, int(i), int(m), fp.tobytes()) for i, m, fp in zip(ids, n, fps, strict=True)]
        part = list(range(size))
        for i in range(size):
            for j in range(i):
                if min(n[i], n[j]) >= 0.8 * max(n[i], n[j]) and np.bitwise_count(fps[i] ^ fps[j]).sum() <= most:
                    part = [part[j] if x == part[i] else x for x in part]
        want |= {frozenset(int(ids[i]) for i in range(size) if part[i] == p) for p in set(part) if part.count(p) > 1}
    links = [(r["a"], r["b"]) for r in near_copies.met_links(spark.createDataFrame(rows, "k long, first long, n int, fp binary"), 0.8, width).collect()]
    root = {i: {i} for r in links for i in r}
    for a, b in links:
        if root[a] is not root[b]:
            root[a] |= root[b]
            for i in root[b]:
                root[i] = root[a]
    assert {frozenset(x) for x in root.values()} == want
    assert len(links) == sum(len(x) - 1 for x in want) and max(map(len, want)) > near_copies.SMALL


def test_fingerprints_meet_through_covering_masks(spark, monkeypatch):
    """Without any shared shingle bucket, fingerprints within operator 5's distance still bring documents together, and texts decide."""
    monkeypatch.setattr(near_copies, "shared_buckets", lambda keyed: keyed.limit(0))
    rows = []
    for i in range(30):
        t = text(600)
        rows += [(10 * i, t), (10 * i + 1, t + " end"), (10 * i + 2, edited(t, 60))]
    prints = {i: int.from_bytes(near_copies.majority(np.unique(near_copies.hashed(t.encode(), 5)), near_copies.WIDTH)[:8], "little") for i, t in rows}
    apart = {i: (prints[i] ^ prints[i + 1]).bit_count() for i in range(0, 300, 10)}
    near = [i for i, d in apart.items() if d <= near_copies.RADIUS]
    got = grouped(spark, rows)
    assert len(near) >= 20 and any(apart[i] for i in near) and all(got[i + 1] == i for i in near)
    assert all(got[i + 2] == i + 2 for i in range(0, 300, 10))
    monkeypatch.setattr(near_copies, "print_links", lambda classes: classes.select(F.lit(0).cast("long").alias("a"), F.col("first").alias("b")))
    assert grouped(spark, rows)[292] == 292
