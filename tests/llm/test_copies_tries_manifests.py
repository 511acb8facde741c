"""Exact copies, conversation tries and manifests against brute force and SQL, with nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import exact, merkle, queries, trie

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_exact_dedup", "op13_merkle_manifest"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cursor = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(cursor.fetchall())
    assert want and Counter(tuple(r[c] for c in names) for r in df.collect()) == want


@pytest.mark.parametrize("n,span", [(0, 10), (1, 1 << 48), (5, 5), (1000, 1 << 48), (1000, 3000), (7, 8)])
def test_golomb_codes_come_back_and_are_short(n, span):
    rng = np.random.default_rng(n)
    prints = np.sort(rng.choice(span, n, replace=False) if span < 1 << 20 else np.unique(rng.integers(0, span, n))).astype(np.uint64)
    code = exact.golomb_encode(np.diff(prints, prepend=np.uint64(0)), exact.parameter(span, len(prints)))
    assert (exact.decoded(code, len(prints), 0, span) == prints).all()
    if n == 1000:
        assert 8 * len(code) / n < np.log2(span / n) + 2.5


@pytest.mark.parametrize("settings", [{}, {"bits": 4, "owner_rows": 7}])  # four bits: nearly all rows are false suspects
def test_copies_against_brute_force(spark, settings, monkeypatch):
    monkeypatch.setattr(exact, "SENDER_ROWS", 40)
    rng = random.Random(3)
    texts = [None, "", " ", "a  b", "a b", "a\t\nb", "a b", "a b", "A b", "x" * 100_000, "x" * 100_001, *map(str, range(30))]
    rows = [(rng.choice([None, *range(300)]), rng.choice(texts), "clash", "clash") for _ in range(500)]
    for given in (rows, rows[:1], []):
        df = spark.createDataFrame(given, "doc_id long, text string, fp string, sha string").repartition(5)
        got, groups = exact.find_copies(df, **settings).collect(), defaultdict(list)
        for i, t, *_ in given:
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
        want = Counter()
        for t, ids in groups.items():
            keep = min((i for i in ids if i is not None), default=None)
            want.update((i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids)
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
        kept = [r for r in got if r["kept"]]
        assert len(kept) == len(groups) == len({r["text_sha256"] for r in kept}) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_double_array_keeps_children_apart():
    rng = random.Random(9)
    rows = sorted(b"".join(bytes([rng.randrange(12)]) * 19 + b"\0" for _ in range(rng.randrange(9))) for _ in range(400))
    array, distinct, codes, lengths = trie.build(rows)
    used = np.flatnonzero(array.check[: array.end] > 0)
    prefixes = {x[: 20 * d] for x in rows for d in range(1, len(x) // 20 + 1)}
    assert len(used) == len(prefixes) and len(distinct) == 12
    assert array.step(np.array([0]), np.array([0]))[0] > 0 and array.step(used[-1:], np.array([10**6]))[0] == -1
    parents = array.check[used] - 1
    code = used - array.base[parents]
    assert ((0 <= code) & (code < 12)).all() and len(set(zip(parents.tolist(), code.tolist(), strict=True))) == len(used)


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        if c is not None:
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32], role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        v = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + v[h:])
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
            if d:
                children[v[: d - 1]].add(v[:d])
        ends[v].append(c)
    leaves, saved = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], sha(ends[p])) for p, m in members.items())


def random_turns(n, texts, seed):
    rng, out = random.Random(seed), []
    for k in range(n):
        c = rng.choice([k * 7, k * 100, k, -k])
        for t in range(rng.randint(1, 9)):
            out.append((rng.choice([c] * 30 + [None]), rng.choice([t, t, t, None, 0]), rng.choice(["u", "u", "a", None]), rng.choice(texts)))
    return out


@pytest.mark.parametrize(
    "rows",
    [
        random_turns(150, ["x", "y", "é𝄞" * 5], 5),
        random_turns(200, ["x", None, "", "yy", "zz"], 6),
        [(c, t, "u", "same") for c in range(100, 220) for t in range(4)],  # one path that all shards share
        [(c, t, "u", f"t{t % 50}") for c, n in ((5, 150), (7, 140)) for t in range(n)],
        [(1, None, None, None)],
        [],
    ],
    ids=["random", "blank", "hot", "deep", "null", "empty"],
)
def test_trie_against_brute_force(spark, rows):
    df = spark.createDataFrame([(*x, "clash") for x in rows], "conv_id long, turn long, role string, text string, turns string").repartition(3)
    sequences = trie.rebuilt(trie.turns(df))
    for shard_rows in (20_000, 17) if len(rows) > 1 else (17,):  # few shards; many, which share their upper nodes
        assert Counter(tuple(r) for r in trie.prefix_nodes(sequences, shard_rows=shard_rows).collect()) == plain_trie(rows)


def plain_manifest(rows, arity):
    H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
    leaf = lambda row: H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    def levels(hashes):
        out = [hashes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
        return out

    def siblings(tree, i):
        out = []
        for level in tree[:-1]:
            a = i - i % arity
            out.append((level[a:i], level[i + 1 : a + arity]))
            i //= arity
        return out

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources]
    trees = [levels([leaf(r) for r in g]) for g in groups]
    top, out = levels([t[-1][0] for t in trees]), Counter()
    for k, (group, tree) in enumerate(zip(groups, trees, strict=True)):
        for i, r in enumerate(group):
            path, found = siblings(tree, i) + siblings(top, k), r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                found = (*r[:4], r[4].replace("\n", ""))
            h = leaf(found)
            for before, after in path:
                h = H(*before, h, *after)
            out[r[0], leaf(r), tree[-1][0], top[-1][0], H(*[x for a, b in path for x in a + b]), h, h == top[-1][0]] += 1
    return out


@pytest.mark.parametrize("arity", [2, 3])
def test_manifest_against_brute_force(spark, arity):
    rng = random.Random(arity)
    sources, texts = [None, "", "a", "a", "a", "b", "é", *"cdefgh"], [None, "", "x\ny", "é\n", "q", "long\n" * 20_000]
    rows = [(rng.choice([None, *range(40)]), rng.choice(sources), rng.choice([None, "de"]), rng.choice([None, 5]), rng.choice(texts)) for _ in range(120)]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    check = {"text": F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    for given in (rows, [rows[0]] * 2, []):
        df = spark.createDataFrame([(*x, "clash", "clash") for x in given], "doc_id long, source string, lang string, n_chars long, text string, tree string, hash string").repartition(3)
        assert Counter(tuple(r) for r in merkle.audit(df, check, arity=arity).collect()) == plain_manifest(given, arity)
