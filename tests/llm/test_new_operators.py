"""Conversation repair, source divergence and source mixing against plain versions."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein.llm import conversation_repair, embedding_dedup, source_divergence, source_mix, token_counts

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", None, "a", 4), (3, "Hello there big words", "en", None, 1), (3, "Hello there big words", "en", None, 1), (3, "hello OTHER words", "en", "b", 1),
    (4, "12 34 !!", "en", "b", 1), (None, "no id at all hello", "en", "b", 1), (-7, "naïve CAFÉ café Ünï_code　x hello", "fr", "b", 1), (5, "long words again " * 30000, "en", "c", 1), (6, "a\0b c", None, None, None), (7, "hello words", "en", "", 1), (8, "words", "en", "c", 1),
]


# Conversations


def plain_repair(rows):
    """The contract's report of (turn, role, text) in order, by shortest paths over whole strings."""
    spaces, faults, seen = " \t\n\x0b\f\r", [], set()
    for _, role, text in rows:
        bare = text.strip(spaces)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    follows, added, names = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}, (2, 2, 3, 2), {2: "user", 3: "assistant"}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        heapq.heappush(heap, (cost + 3, audit + "I", i, added[state], (*out, (names[added[state]], ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                if (kept := follows.get((role[:1], state))) is not None:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, kept, (*out, (role, text))))
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, added[state], (*out, (names[added[state]], text))))
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    }


def by_order(rows):
    """(turn, role, text, copy) of one conversation as ordered() has them."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest(), r[3])
    return [r[:3] for r in sorted(rows, key=key)]


def plain_damage(table):
    out = {}
    for conv, turn, role, text in table:
        rows = out.setdefault(conv, [])
        say = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text, c) for c in range(1 + (kind == 3))]
    return {c: plain_repair(by_order(rows)) for c, rows in out.items()}


def reports(df):
    return {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}


def test_conversation_repair_query(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = plain_damage(con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall())
    assert reports(conversation_repair.op11_conversation_repair(spark, SF)) == want
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    by_sql = con.sql(f"SELECT conv_id, {', '.join(names)} FROM ({conversation_repair.OP11_SQL})").fetchall()
    assert {c: dict(zip(names, r)) for c, *r in by_sql} == want


@pytest.mark.parametrize("piece", [1, 3, 128])
def test_conversations_in_pieces(spark, monkeypatch, piece):
    """All short role sequences and some long ones, however they are cut."""
    monkeypatch.setattr(conversation_repair, "PIECE", piece)
    rng, convs = random.Random(piece), {}
    roles, texts = ["system", "user", "assistant", "tool", "", "unknown"], ["done.", "cut", " \n", "well!", "so?"]
    for i in range(150):
        n = rng.choice([0, 1, 2, 3, 5, 8, 13, 40])
        convs[i] = [(t // 2 if rng.random() < 0.3 else t, rng.choice(roles), f"{rng.choice(texts)}" if rng.random() < 0.5 else f"{t} {rng.choice(texts)}", 0) for t in range(n)]
    df = spark.createDataFrame([(c, *r[:3]) for c, rows in convs.items() for r in rows], TURNS)
    found = conversation_repair.repair(df)
    want = {c: by_order(rows) for c, rows in convs.items()}
    assert reports(found.report(spark.createDataFrame([(c,) for c in convs], "conv_id long"))) == {c: plain_repair(rows) for c, rows in want.items()}
    lines = {}
    for r in found.repaired().orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(r)
    for rows in lines.values():
        assert [r.place for r in rows] == list(range(1, len(rows) + 1)) and re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in rows))
        assert all(r.text == "" for r in rows if r.edit == "I")


def test_conversation_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "hi."), (None, None, "user", "hi."), (5, None, "assistant", "x" * 300_000), (5, 2, "user", "a\0b"), (5, 2, "user", "a\0b"), (9, 7, "user", ""), (-3, 2**60, "system", "only this.")]
    df = spark.createDataFrame(rows, TURNS).withColumns({n: F.lit("mine") for n in ("pos", "copy_", "digest", "blank", "piece", "signature", "ends")})
    damaged = conversation_repair.damage(df)
    assert reports(conversation_repair.repair(damaged).report(df)) == plain_damage(rows)
    assert conversation_repair.repair(damaged.limit(0)).report(df.limit(0)).count() == 0


def test_signature_costs_are_least():
    """Every signature of up to four letters against all edits, for each state it may start in."""
    letters = "suaoSUAO1"
    for n in range(4):
        for signature in map("".join, itertools.product(letters, repeat=n)):
            m = conversation_repair.matrix(signature)
            for state in range(4):
                audit, end = conversation_repair.solve(signature, conversation_repair.LAST, state)
                cost = conversation_repair.spent(audit, signature) + conversation_repair.LAST[end]
                assert cost == conversation_repair.to_go(signature, conversation_repair.LAST)[state] == min(m[4 * state + t] + conversation_repair.LAST[t] for t in range(4))


# Divergence


def by_sql(rows, sql):
    con = duckdb.connect()
    kinds = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()}
    con.register("documents", pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(kinds.items())}))
    return con.sql(f"SELECT lang, source, part, item, value, rank FROM ({sql})").fetchall()


@pytest.mark.parametrize(("terms", "tile"), [(8192, 128), (300, 3)])
def test_source_divergence_query(spark, monkeypatch, terms, tile):
    monkeypatch.setattr(source_divergence, "BLOCK_TERMS", terms)
    monkeypatch.setattr(source_divergence, "TILE_GROUPS", tile)
    monkeypatch.setattr(source_divergence, "HELD_TERMS", terms)
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet'").fetchall()
    got = source_divergence.op12_source_divergence(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(by_sql(rows, source_divergence.OP12_SQL))


@pytest.mark.parametrize("tile", [1, 128])
def test_divergence_odd_rows(spark, monkeypatch, tile):
    monkeypatch.setattr(source_divergence, "TILE_GROUPS", tile)
    rows = ODD + [(20 + i, "same words here", "de", s, 0) for i, s in enumerate(["x", "y", None, ""])]
    df = spark.createDataFrame(rows, FIELDS).withColumns({n: F.lit("mine") for n in ("term", "n", "docs", "block", "tile", "first")})
    assert sorted(map(tuple, source_divergence.audit(df).collect())) == sorted(by_sql(rows, source_divergence.OP12_SQL))
    assert source_divergence.audit(df.limit(0)).count() == 0


def test_shares_are_exact():
    rng = random.Random(1)
    counts = [0, 1, 10**15 - 2, *(rng.randrange(10**15) for _ in range(200))]
    totals = [10**15, 10**15 + 7, 8 * 10**15, *(rng.randrange(10**15, 9 * 10**15) for _ in range(200))]
    got = source_divergence.shares(np.array(counts), np.array(totals))
    assert got.tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(counts, totals)]
    p, q = np.array([[10**9 + 1, 1, 5]]), np.array([[1, 10**9 + 1, 5]])
    assert source_divergence.pair_matrix(p, q).tolist() == [[10**18 + 10**18 // (10**9 + 1)]]


# Mixing


def plain_targets(sizes, weights=(3, 1, 2)):
    """Shares by weight; what is above twice a size is shared out again, step by step."""
    w = [weights[i % 3] for i in range(len(sizes))]
    total = Fraction(3, 2) * sum(sizes)
    given = [total * x / sum(w) for x in w]
    while any(g > 2 * s for g, s in zip(given, sizes)):
        full = [g >= 2 * s for g, s in zip(given, sizes)]
        excess = sum((g - 2 * s for g, s in zip(given, sizes) if g > 2 * s), Fraction(0))
        given = [min(g, Fraction(2 * s)) for g, s in zip(given, sizes)]
        parts = sum(x for x, f in zip(w, full) if not f)
        given = [g if f else g + excess * x / parts for g, x, f in zip(given, w, full)]
    return given


def test_mix_targets():
    rng = random.Random(4)
    for n in range(1, 30):
        sizes = [rng.choice([0, 1, rng.randrange(1000), 10**12]) for _ in range(n)]
        if sum(sizes):
            assert source_mix.targets(sizes) == plain_targets(sizes)
    assert source_mix.targets([]) == [] and source_mix.targets([0, 0]) == [0, 0]


def test_nearest_subset():
    rng = random.Random(5)
    for _ in range(200):
        sizes = [rng.choice([0, rng.randrange(1, 40)]) for _ in range(rng.randrange(1, 10))]
        want = rng.randrange(1, 80)
        best = min(abs(sum(c) - want) for n in range(len(sizes) + 1) for c in itertools.combinations(sizes, n))
        got = source_mix.nearest_subset(sizes, want)
        assert len(set(got)) == len(got) and abs(sum(sizes[i] for i in got) - want) == best
    big = [rng.randrange(10**6, 10**7) for _ in range(300)]
    assert abs(sum(big[i] for i in source_mix.nearest_subset(big, 5 * 10**8)) - 5 * 10**8) < 300 * 1000


def test_splitting_tree_is_exact():
    quotas = [0, 1, 7, 500, 12_000]
    tree = source_mix.splitting_tree(quotas, 16)
    assert tree.sum(0).tolist() == quotas and (tree >= 0).all() and np.ptp(tree.sum(1)) <= 4
    assert (tree == source_mix.splitting_tree(quotas, 16)).all() and source_mix.splitting_tree([], 4).shape == (4, 0)
    # A shard's draw from the largest source is its share, give or take what chance allows.
    assert (abs(tree[:, 4] - 750) < 100).all() and len(set(tree[:, 4])) > 1


def plain_size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_source_mix_query(spark):
    table = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    got = source_mix.op13_source_mix(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, source_mix.op13_source_mix(spark, SF).collect()))
    text = {d: (plain_size(t), s) for d, t, s in table}
    assert len(got) == len(table) and all(r.size == text[r.doc_id][0] and r.taken in (0, r.size, 2 * r.size) for r in got)
    sizes = Counter()
    for n, s in text.values():
        sizes[s] += n
    order = sorted(sizes)
    targets = dict(zip(order, plain_targets([sizes[s] for s in order])))
    taken = Counter()
    for r in got:
        s = text[r.doc_id][1]
        assert r.source_size == sizes[s] and r.target == float(targets[s])
        taken[s] += r.taken
    # A source holds ten documents here; the subset sum comes within a few words all the same.
    assert all(abs(taken[s] - float(targets[s])) <= max(5, 0.02 * sizes[s]) for s in order)


def test_mix_takes_blocks_apart(spark, monkeypatch):
    """Many documents of one id and text, so a block is halved down to the bits of rows."""
    monkeypatch.setattr(source_mix, "BLOCKS", 8)
    rows = [(1, "three words here", "en", "a", 0)] * 3000 + [(i, "w " * (i % 50), "en", "b" if i % 4 else None, 0) for i in range(2000)]
    docs = spark.createDataFrame(rows, FIELDS)
    got = source_mix.drawn(docs, leaf=20).select("size", "source_size", "target", F.size("draws").alias("k"), "draws").collect()
    by = {}
    for r in got:
        size, target, taken, ks = by.get(r.source_size, (0, r.target, 0, set()))
        by[r.source_size] = size + r.size, target, taken + r.size * r.k, ks | {r.k}
    assert all(size == s and abs(taken - target) <= 25 and ks <= {0, 1, 2} and max(ks) - min(ks) <= 1 for s, (size, target, taken, ks) in by.items() if s > 0)
    assert {d.shard for r in got for d in r.draws} <= set(range(source_mix.SHARDS))


def test_mix_rows_and_odd_tables(spark, tmp_path):
    odd = spark.createDataFrame(ODD, FIELDS).withColumns({n: F.lit("mine") for n in ("shard", "pass", "turn", "row", "size", "key", "block")})
    draws = Counter()
    for r in source_mix.drawn(odd).collect():
        draws[r.doc_id, r.size] += len(r.draws)
    mix = source_mix.mixed(odd)
    assert mix.columns == [*odd.columns, "shard_", "pass_", "turn_"]
    assert Counter((r.doc_id, plain_size(r.text)) for r in mix.collect()) == +draws
    assert all(r["shard"] == "mine" for r in mix.collect())
    source_mix.write_mix(odd, f"{tmp_path}/mix", shards=3)
    back = spark.read.parquet(f"{tmp_path}/mix")
    assert back.count() == sum(draws.values()) and {r["shard_"] for r in back.select("shard_").distinct().collect()} <= {0, 1, 2}
    assert source_mix.drawn(odd.limit(0)).count() == 0 and source_mix.mixed(odd.limit(0)).count() == 0


def test_stalled_writer_hides_no_batch(spark, tmp_path, monkeypatch):
    """Token counts: an attempt that stalls between its marker and its commit, and goes on after a retry."""
    docs = spark.createDataFrame(ODD, FIELDS)
    rows = token_counts.inserts(token_counts.counted(docs, "w", token_counts.words(F.col("text"))))
    store, stalled = (token_counts.Rollup(spark, f"file://{tmp_path}/rollup") for _ in range(2))
    put = stalled._put

    def put_and_stall(name, content):
        put(name, content)
        if name.startswith("batches/"):
            raise TimeoutError

    monkeypatch.setattr(stalled, "_put", put_and_stall)
    with pytest.raises(TimeoutError):
        stalled.apply("a", rows)
    assert not store.applied("a") and store.apply("b", rows) and store.apply("a", rows)
    with pytest.raises(TimeoutError):
        put_and_stall(f"{stalled._marker('a')}/1", {"batch": "a"})
    assert store.applied("a") and not store.apply("a", rows) and store.batches() == ["b", "a"]


def test_chunks_of_long_vectors_are_small(spark, monkeypatch):
    """Embeddings: chunks bounded by bytes give the links that plain products give."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 300))
    vectors = np.concatenate([base, base[:15] + rng.normal(size=(15, 300)) * 0.05, base[:5] + rng.normal(size=(5, 300)) * 0.05])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(embedding_dedup, "CHUNK_BYTES", 8 * 300 * 7)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    for i in range(len(vectors)):
        reach = {i}
        while len(grown := reach | {int(j) for k in reach for j in np.flatnonzero(near[k])}) > len(reach):
            reach = grown
        assert got[i] == (int(near[i].sum()) - 1, min(reach))
