"""Each operator against a plain version, and its defined results for odd rows."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skein.llm import decontamination, embedding_dedup, language_id, packing, sharding, simhash, token_counts, token_files, tokens, toxicity, url_filter
from skein.llm import common
from skein.llm.common import components

SF = "/root/testdata/sf0.001"
FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls everywhere, empty and blank texts, repeated rows, two texts of one id, a very long one.
ODD = [
    (None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", None, "a", 4), (3, "Hello there, big world of many words here", "en", None, 1), (3, "Hello there, big world of many words here", "en", None, 1),
    (3, "another text", "en", "b", 1), (4, "12 34 !!", "en", "b", 1), (None, "no id at all", "de", "b", 1), (-7, "naïve café Ünïcode  \x1c x", "fr", "b", 1), (5, "long words again " * 60000, "en", "c", 1), (6, "a\0b �", None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, FIELDS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def extra(df, *names):
    """df with columns whose names clash with those an operator adds."""
    return df.withColumns({n: F.lit("mine") for n in names})


# Language


def test_language_by_compression(spark, docs):
    texts = {"en": "the quick brown fox and the lazy dog went over the hill ", "de": "der schnelle braune fuchs und der faule hund gingen über den berg "}
    rng = random.Random(2)
    mixed = lambda lang: " ".join(rng.sample(texts[lang].split(), 8))
    df = spark.createDataFrame([(i, mixed("en" if i % 2 else "de"), "en" if i % 2 else "de") for i in range(200)], "doc_id long, text string, lang string")
    model = language_id.fit(df, F.col("doc_id") < 100)
    assert set(model) == {"en", "de"}
    got = language_id.classify(df.where("doc_id >= 100"), model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 98 and all(0 <= r.score <= 1 for r in got)
    # The sizes are those of plain compression with each dictionary.
    judge = language_id.Classifier(model)
    assert all(judge.judge(r.text)[:2] == (r.lang_pred, r.score) for r in got)


def test_language_odd_rows(spark, odd):
    model = language_id.fit(odd)
    got = language_id.classify(extra(odd, "score", "margin"), model).collect()
    assert len(got) == len(ODD)
    for r in got:
        letters = any(x.isalpha() for x in r.text or "")
        assert (r.lang_pred == "und" and r.score == 0 and not r.accepted) or letters
    assert [r.lang_pred for r in language_id.classify(odd, language_id.fit(odd.limit(0))).collect()] == ["und"] * len(ODD)
    assert language_id.classify(odd.limit(0), model).count() == 0


def test_language_numbers_are_no_letters(spark):
    model = language_id.fit(spark.createDataFrame([("some words of this language", "en"), ("einige worte dieser sprache", "de")], "text string, lang string"))
    texts = ["²³", "½ ¼", "Ⅷ ٣", "_", "x²", "á"]
    rows = language_id.classify(extra(spark.createDataFrame([(x,) for x in texts], "text string"), "__lid", "__lid_"), model).collect()
    assert [r.lang_pred == "und" for r in rows] == [True] * 4 + [False] * 2 and rows[0]["__lid"] == "mine"


def test_language_hot_text_counts_once(spark):
    rows = [(0, "same text as ever here", "en")] * 3000 + [(i, f"other words number {i} come", "en") for i in range(50)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model["en"].count(b"same text") == 1 and model["en"].count(b"other words") == 50


def test_language_slices_come_from_whole_texts(spark):
    # The slices of one long text and of many short ones are drawn alike, the last one included.
    text = " ".join(f"word{i:05}" for i in range(400))
    model = language_id.fit(spark.createDataFrame([(text, "en")], "text string, lang string"))
    assert len(model["en"]) >= len(re.sub(r"\d", "", text)) and model["en"].count(b"word") >= 390


def plain_language(text, dictionaries):
    """(language, score) by one compression after the other."""
    import zstandard

    data = re.sub(r"\s+", " ", "".join(x if x.isalpha() else " " for x in (text or "").lower())).strip().encode()
    if not data:
        return "und", 0.0
    if len(data) < 64:
        data = b" ".join([data] * (64 // len(data) + 1))
    sizes = []
    for lang, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        c = zstandard.ZstdCompressor(dict_data=d, level=3, write_content_size=False)
        sizes.append((sum(len(c.compress(data[i : i + 2048])) for i in range(0, len(data), 2048)), len(sizes), lang))
    best, second = sorted(sizes)[:2]
    return best[2], min(1.0, 0.5 + 5 * (second[0] - best[0]) / len(data))


def test_language_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs, ~language_id.held_out())
    rows = {r.doc_id: r for r in docs.collect()}
    got = language_id.op2_language_id(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        want = plain_language(rows[r.doc_id].text, model)
        assert r.lang_pred == want[0] and r.score == pytest.approx(want[1])
    tested = [(r.lang_pred, rows[r.doc_id].lang) for r in got if r.held_out and rows[r.doc_id].lang and r.lang_pred != "und"]
    assert sum(a == b for a, b in tested) >= 0.95 * len(tested)


# SimHash


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(simhash._LOWER))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    ones = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    ids = sorted(prints)
    want = plain_components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4])
    got = simhash.op3_simhash(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{prints[i]:016x}", want[i]) for i in ids}


@pytest.mark.parametrize("chunk", [8192, 7])
def test_simhash_links(spark, chunk):
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = list({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(15)})
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    got = simhash.links(df, chunk=chunk).collect()
    u = lambda x: x & (2**64 - 1)
    assert all((u(r.a) ^ u(r.b)).bit_count() <= 4 for r in got)
    want = plain_components(prints, [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 4])
    assert plain_components(prints, [(u(r.a), u(r.b)) for r in got]) == want


def test_simhash_odd_rows(spark, odd):
    got = simhash.near_duplicates(extra(odd, "fp", "root")).collect()
    assert len(got) == len(ODD)
    # Texts without words are linked with one another.
    assert {r.component_id for r in got if r.fp == 0} == {1}
    kept = simhash.drop_near_duplicates(extra(odd, "fp", "root", "component_id"))
    assert kept.columns == [*odd.columns, "fp", "root", "component_id"]
    assert kept.count() == len({r.root for r in got})
    assert simhash.drop_near_duplicates(odd.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(80)] + [(None, 3), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [p for p in pairs if None not in p and p[0] != p[1]]
    assert got == plain_components({x for p in real for x in p}, real)


# Token files, packing


def encoders():
    from tokenizers import Tokenizer

    load = lambda p: Tokenizer.from_file(p)
    return {"byte": load(token_files.byte_vocabulary()), "word": load(packing.word_vocabulary())}


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_encoder(spark, docs, kind):
    path = token_files.byte_vocabulary() if kind == "byte" else packing.word_vocabulary()
    ours, library = tokens.encoder(path, kind), encoders()[kind]
    rng = random.Random(1)
    noise = ["".join(rng.choice("aé ß\n\t  .,!'sİÍ\x00\x1c 漢🙂09_-") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    for x in [*(r.text for r in docs.collect()), *(r[1] for r in ODD if len(r[1] or "") < 1000), *noise]:
        assert np.frombuffer(ours.encode(x), "<u4").tolist() == (library.encode(x, add_special_tokens=False).ids if x else []), repr(x)


def test_encoder_learns_parts_of_ascii():
    # Only the merge model is asked: pieces with hyphens, digits or short endings are cut as the library's
    # splitter cuts them, and a word is kept once, whatever stands after it.
    ours, library = tokens.Encoder(token_files.byte_vocabulary(), "byte"), encoders()["byte"]
    ours.tokenizer = None
    text = "Vorlane-tiske they're ab12cd, (x_y) 'tis don't! $9.50 word word, word. a--b ~|> end's"
    for x in (text, "'s", "-", "it'll'", text[::-1]):
        assert np.frombuffer(ours.encode(x), "<u4").tolist() == library.encode(x, add_special_tokens=False).ids, x
    assert " word" not in ours.parts and {"word", "word,", "word."} <= ours.cache.keys()


def test_token_files_query(spark):
    library = encoders()["byte"]
    at, want = 0, []
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, at, ids.size, zlib.crc32(ids.tobytes())))
        at += ids.size
    assert sorted(tuple(r) for r in token_files.op4_token_files(spark, SF).collect()) == want


def test_token_files_odd_rows_and_lookup(spark, odd, tmp_path):
    folder = f"{tmp_path}/ids"
    token_files.write(extra(odd, "start"), folder, token_files.byte_vocabulary(), partitions=3)
    got = token_files.read(spark, folder).collect()
    assert len(got) == len(ODD) and sum(r.doc_id is None for r in got) == 2
    reader, library = token_files.Reader(folder), encoders()["byte"]
    for key in (1, 2, 4, 5, 6, -7):
        text = next(t for i, t, *_ in ODD if i == key)
        assert reader.ids(key).tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]
    assert reader.ids(99) is None and reader.ids(-(10**15)) is None
    with pytest.raises(Exception, match="does not fit"):
        token_files.write(odd.where("doc_id = 3"), f"{tmp_path}/narrow", token_files.byte_vocabulary(), width=1)
    token_files.write(odd.limit(0), f"{tmp_path}/none", token_files.byte_vocabulary())
    assert token_files.read(spark, f"{tmp_path}/none").count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(0).integers(-(2**62), 2**62, 20000))
    h = token_files.PerfectHash.build(keys)
    assert sorted(h.find(keys)) == list(range(keys.size))
    assert (h.find(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()


def test_token_files_read_by_hash(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i % 7}") for i in range(300)] + [(7, "again")] * 40
    folder = f"{tmp_path}/ids"
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string"), folder, token_files.byte_vocabulary(), partitions=2)
    fs, inside = token_files.open_fs(folder)
    for r in token_files.manifest_of(folder):
        index = token_files._index(fs, f"{inside}/{r['name']}")
        assert index.rows_of().tolist() == list(range(r["docs"]))
        # A lookup reads a small part of the index, whatever its size.
        reads = []
        file = fs.open_input_file(f"{inside}/{r['name']}.idx")

        class Counting:
            def read_at(self, n, at):
                reads.append(n)
                return file.read_at(n, at)

        look = token_files.Lookup(Counting())
        for key in set(index.keys.tolist()):
            row = index.row(key) if hasattr(index, "row") else index.keys.tolist().index(key)
            reads.clear()
            assert look.place(key) == (index.starts[row], index.starts[row + 1])
            assert sum(reads) < 400
        # A broken hash is noticed.
        index.hash.fingerprints = index.hash.fingerprints + np.uint32(1)
        with pytest.raises(ValueError):
            index.rows_of()


def check_packing(rows, capacity, lengths):
    assert Counter(r.length for r in rows) == Counter(lengths)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_query(spark):
    library, lengths, digests = encoders()["word"], [], {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for i in range(0, ids.size, 2048):
            lengths.append(ids[i : i + 2048].size)
            digests[r.doc_id, i // 2048] = (i, zlib.crc32(ids[i : i + 2048].tobytes()))
    rows = packing.op5_best_fit_packing(spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.ids_crc32) for r in rows} == digests
    bins = check_packing(rows, 2048, lengths)
    assert bins <= -(-sum(lengths) // 2048) + max(2, len(lengths) // 50)


def test_fullest_is_exact():
    rng = random.Random(6)
    for _ in range(200):
        counts = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room = rng.randint(1, 40)
        reach = {0}
        for n, c in counts.items():
            reach |= {x + n * k for x in reach for k in range(c + 1) if x + n * k <= room}
        chosen = packing.fullest(dict(counts), room)
        assert sum(chosen) == max(reach) and all(chosen.count(n) <= counts[n] for n in chosen)


def test_packing_large_ids_beside_null(spark):
    ids = [9007199254740993, 1152921504606846979, None, -9007199254740993, 0]
    df = spark.createDataFrame([(i, "some words here") for i in ids], "doc_id long, text string").coalesce(1)
    assert Counter(r.doc_id for r in packing.pack(df, packing.word_vocabulary()).collect()) == Counter(ids)


def test_packing_fills_what_first_fit_leaves():
    # First fit by falling length needs a third sequence for these.
    histogram = {6: 1, 5: 2, 4: 1, 3: 2, 2: 2}
    assert sum(n for n, _ in packing.plan(histogram, 15)) == 2
    rng = random.Random(1)
    for _ in range(100):
        counts = Counter(rng.randint(1, 12) for _ in range(rng.randint(0, 9)))
        planned = packing.plan(dict(counts), 12)
        assert sum((Counter({n: k * times for n, k in Counter(c).items()}) for times, c in planned), Counter()) == counts
        assert all(sum(c) <= 12 for _, c in planned)


def test_packing_odd_rows(spark, odd):
    rows = packing.pack(extra(odd, "length", "rank"), packing.word_vocabulary(), capacity=64).collect()
    assert sum(r.doc_id is None for r in rows) == 2 and Counter(r.doc_id for r in rows)[1] == 1
    check_packing(rows, 64, [r.length for r in rows])
    assert packing.pack(odd.limit(0), packing.word_vocabulary()).count() == 0


# Decontamination


def plain_hits(text, items, window=13):
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").translate({c: c + 32 for c in range(65, 91)}))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        for i in range(max(1, len(x) - window + 1) if x else 0):
            p = x[i : i + window]
            for j in range(len(w) - len(p) + 1):
                if w[j : j + len(p)] == p:
                    hit.update(range(j, j + len(p)))
                    found.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("limit", [1 << 20, 9])
def test_decontamination(spark, limit):
    rng = random.Random(8)
    word = lambda: rng.choice(["Alpha", "beta", "GAMMA", "déjà", "x1"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 5, 6, 40])))) for i in range(12)] + [(3, "repeat beta"), (3, "repeat beta"), (None, "null item"), (20, None)]
    rows = [(i, "; ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(60)] + [(61, None), (62, ""), (63, "the null item is here, REPEAT   beta!")]
    b = spark.createDataFrame(items, "item_id long, text string")
    d = extra(spark.createDataFrame(rows, "doc_id long, text string"), "n_hit", "__hit", "__row")
    got = {r.doc_id: r for r in decontamination.scan(d, b, limit, window=4).collect()}
    for i, text in rows:
        n, hit, found = plain_hits(text, [x for x in items if x[1]], 4)
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest())
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
        assert all(0 <= a < z <= len(text) for a, z in r.hits)
    assert [text[a:z] for text in [rows[-1][1]] for a, z in got[63].hits] == ["null item", "REPEAT   beta"]
    assert not any(r.contaminated for r in decontamination.scan(d, b.limit(0)).collect())
    assert decontamination.scan(d.limit(0), b).count() == 0


def test_automaton_windows():
    # Two letters make for many chance matches, long runs and items inside each other.
    rng = random.Random(12)
    for window in (2, 5, 13):
        for _ in range(60):
            text = lambda most: b" ".join(rng.choice([b"a", b"b"]) for _ in range(rng.randint(0, most)))
            items = [(str(i), text(30)) for i in range(6)]
            d = text(60)
            runs, found = decontamination.Automaton(items, window).scan(decontamination.words(d))
            n, hit, want = plain_hits(d.decode(), [(i, t.decode()) for i, t in items], window)
            assert sum(b - a for a, b in runs) == hit and sorted(found) == want
    many = [(str(i), b" ".join(b"w%d" % rng.randint(0, 900) for _ in range(40))) for i in range(60)]
    a = decontamination.Automaton(many)
    assert a.digits == 2 and a.scan(decontamination.words(b"x " + many[7][1]))[0] == [(1, 41)]


# URLs


def plain_verdicts(pages):
    url = lambda u: (lambda m: (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", ""))(re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or ""))
    table, edges = [], Counter()
    for i, u, html in pages:
        host, path = url(u)
        fits = [(len(h) + len(p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        table.append((i, host, path, *(max(fits)[1:] if fits else (None, None))))
        for link in re.findall(r'href="((?:\w+:)?//[^"]*)"', html or ""):
            to = url(link if "://" in link else "x:" + link)[0]
            if host and to and host != to:
                edges[host, to] += 1
    pages_of, good, bad = Counter(), Counter(), Counter()
    for _, host, _, _, v in table:
        pages_of[host] += 1
        good[host] += v == "allow"
        bad[host] += v == "block"
    hosts = {h for h in pages_of if h} | {x for e in edges for x in e}

    def rank(seed, links):
        total = Counter()
        for (a, _), n in links.items():
            total[a] += n
        s = {h: seed[h] / max(1, pages_of[h]) for h in hosts}
        first = dict(s)
        for _ in range(400):
            new = dict(first)
            for (a, b), n in links.items():
                new[b] += url_filter.DAMPING * s[a] * n / total[a]
            s = new
        return s

    trust, distrust = rank(good, edges), rank(bad, Counter({(b, a): n for (a, b), n in edges.items()}))
    return {(i, h, p, r, v or ("block" if distrust.get(h, 0) - trust.get(h, 0) >= url_filter.THRESHOLD else "allow")) for i, h, p, r, v in table}


def test_url_filter(spark):
    rng = random.Random(3)
    hosts = ["a.example.com", "B.example.net", "example.org", "com", "x.net", "lone.io", "spam.biz", "fan.biz"]
    pages = [(i, f"http://{rng.choice(hosts)}{rng.choice(['/en/1', '/en/7', '/de/8', '/es/', '', '?q=/en/'])}", "".join(f'<a href="//{rng.choice(hosts)}/x">' for _ in range(rng.randint(0, 3)))) for i in range(120)]
    pages += [(200, None, None), (201, "no scheme", "<a href=x>"), (202, "http://lone.io/a", None), (202, "http://lone.io/a", None), (None, "://", "")]
    pages += [(300 + i, "http://spam.biz/", '<a href="https://b.example.net/">') for i in range(3)]
    pages += [(400, "http://bad.example.net/de/8", ""), (401, "http://admirer.biz/", '<a href="//bad.example.net/">'), (402, "http://bad.example.net/de/80", '<a href="//admirer.biz/">')]
    df = extra(spark.createDataFrame(pages, "page_id long, url string, html string"), "host", "verdict")
    got = url_filter.filter_urls(df).collect()
    assert len(got) == len(pages)
    want = plain_verdicts(pages)
    assert {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got} == want
    # The SQL, which loops as well, says the same.
    import duckdb
    import pandas

    con = duckdb.connect()
    con.register("pages", pandas.DataFrame(pages, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"}))
    rows = con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.OP7_SQL})").fetchall()
    assert set(rows) == want and any(v == "block" and r is None for *_, r, v in rows)
    assert url_filter.filter_urls(df.limit(0)).count() == 0


# Embeddings


def plain_units(rows):
    ok = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    return {i: (v / abs(v).max()) / np.linalg.norm(v / abs(v).max()) for i, v in ok.items()}


@pytest.mark.parametrize("chunk, bits", [(embedding_dedup.CHUNK, None), (9, 0), (50, 3), (9, 5)])
def test_embeddings(spark, chunk, bits):
    rng = np.random.default_rng(7)
    seeds = rng.standard_normal((8, 24))
    rows = [(i, (seeds[i % 8] + rng.standard_normal(24) * rng.choice([0.05, 0.25, 0.4])).tolist()) for i in range(90)]
    rows += [(100 + i, rows[0][1]) for i in range(6)] + [(200, None), (201, [0.0] * 24), (202, [float("nan")] * 24), (203, [None] * 24), (204, [1.0, 2.0]), (205, [2.0, 4.0]), (206, []), (207, [1e300] * 24), (208, [1e300] * 24), (209, [float("inf")] * 24), (210, [0.0, 1.0]), (211, [-0.0, 1.0])]
    df = extra(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "n_links", "component_id", "h1", "cid")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, chunk=chunk, cell_bits=bits).collect()}
    unit = plain_units(rows)
    linked = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    roots, n = plain_components([i for i, _ in rows], linked), Counter(x for p in linked for x in p)
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (n[i], roots[i], roots[i] == i) for i, _ in rows}
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_query(spark):
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    unit = plain_units(rows)
    linked = [(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] >= 0.9]
    roots, n = plain_components([i for i, _ in rows], linked), Counter(x for p in linked for x in p)
    got = embedding_dedup.op8_embedding_dedup(spark, SF).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {(i, n[i], roots[i], roots[i] == i) for i, _ in rows}


@pytest.mark.parametrize("by_cells", [True, False])
def test_embedding_search(by_cells):
    # Groups far apart, groups that lie across the cuts, and lone vectors.
    rng = np.random.default_rng(3)
    seeds = rng.standard_normal((30, 40))
    x = np.vstack([seeds[rng.integers(0, 30, 500)] + rng.standard_normal((500, 40)) * rng.choice([0.1, 0.2, 0.35], (500, 1)), rng.standard_normal((200, 40))])
    unit = embedding_dedup.units(x)
    want = unit @ unit.T >= 0.9
    np.fill_diagonal(want, False)
    for split in (None, 300):
        g = embedding_dedup.Group(x, np.ones(len(x), np.int64), np.arange(len(x)), 0.9)
        g.by_cells = by_cells
        for b in range(len(g.parts)):
            if split is None:
                g.search(b, np.arange(len(x)))
            else:
                g.search(b, np.arange(split), np.arange(split, len(x)))
        full = want if split is None else want & (np.arange(len(x))[:, None] < split) ^ want & (np.arange(len(x)) < split)
        assert (g.links == full.sum(axis=1)).all()
        roots = plain_components(range(len(x)), [tuple(e) for e in np.argwhere(full)])
        assert plain_components(range(len(x)), g.forest.edges) == roots


def test_rotation_keeps_distances():
    x = np.random.default_rng(0).standard_normal((20, 37))
    unit = embedding_dedup.units(x)
    assert np.allclose(embedding_dedup.rotated(unit) @ embedding_dedup.rotated(unit).T, unit @ unit.T, atol=1e-5)
    assert (embedding_dedup.rotated(unit[:1]) == embedding_dedup.rotated(unit)[:1]).all()


# Toxicity


def test_toxicity(spark):
    rng = random.Random(5)
    plain = "morning garden table window river slowly bread paper music follow number winter".split()
    spaced = lambda w: "".join(c + rng.choice(["", "", "x", "."]) for c in w)
    row = lambda i: (i, " ".join(rng.sample(plain, 6) + ([spaced("blorkhead")] if i % 2 else [])) + ".", i % 2)
    rows = [row(i) for i in range(400)]
    d = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(5, None), (9999, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(d, labels, F.col("doc_id") < 300)
    got = toxicity.score(d.where("doc_id >= 300"), model).collect()
    assert sum(r.predicted == r.doc_id % 2 for r in got) >= 97


def plain_kernel(a: str, b: str) -> float:
    """Shared triples of letters that span six at most, weighted by what they span, over the root of
    the kernels of words of so many different letters with themselves."""

    def triples(w):
        out = defaultdict(float)
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + 6)):
                    out[w[i], w[j], w[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    x, y = triples(a), triples(b)
    own = lambda n: sum(toxicity.DECAY ** (2 * (k - i + 1)) for i in range(n) for j in range(i + 1, n) for k in range(j + 1, min(n, i + 6)))
    return sum(w * y[t] for t, w in x.items() if t in y) / (own(len(a)) * own(len(b))) ** 0.5


def test_toxicity_kernel_and_table():
    rng = random.Random(3)
    words = ["idiot", "idxiot", "ixdxixoxt", "garden", "wonderful", "abc", "pneumono" * 12] + ["".join(rng.choice("abcdeio") for _ in range(rng.randint(3, 12))) for _ in range(20)]
    raw = [w.encode() for w in words]
    assert np.allclose(toxicity.kernels(raw, raw[:9]), [[plain_kernel(a, b) for b in words[:9]] for a in words])
    rows = [(f"the quiet garden number {i} is {'an idiot there' if i % 2 else 'a place for walks'}.", i % 2) for i in range(60)]
    model = toxicity.train(rows)
    # The table of triples gives what the kernels with the landmarks give.
    k = np.array([[plain_kernel(a.decode(), b.decode()) for b in model.landmarks] for a in model.landmarks])
    direct = np.array([[plain_kernel(w, b.decode()) for b in model.landmarks] for w in words])
    margins = np.array([model.margins(w.encode())[0] for w in words]) - model.bias
    solved = np.linalg.lstsq(k, np.array([model.margins(z)[0] for z in model.landmarks]) - model.bias, rcond=1e-9)[0]
    assert np.allclose(direct @ solved, margins, atol=1e-4)


def test_toxicity_query(spark):
    rows = toxicity.op9_toxicity(spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    clean = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    toxic = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    assert sum(clean) <= 0.02 * len(clean) and sum(toxic) >= 0.6 * len(toxic)


def test_toxicity_odd_rows(spark, odd):
    labels = spark.createDataFrame([(3, 1), (5, 0), (4, 0)], "doc_id long, toxic int")
    for model in (toxicity.fit(odd, labels), toxicity.fit(odd, labels.limit(0))):
        got = toxicity.score(extra(odd, "score", "predicted"), model).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.score(odd.limit(0), model).count() == 0


# Token counts, shards


def test_token_counts(spark, odd, tmp_path):
    store = token_counts.Rollup(spark, f"file://{tmp_path}/rollup")
    assert store.read().count() == 0 and store.batches() == []
    old = token_counts.counted(odd, "w", token_counts.words(F.col("text")))
    assert store.apply("a", token_counts.inserts(old)) and not store.apply("a", token_counts.inserts(old))
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = Counter()
    for _, t, lang, source, _ in ODD:
        want[source, lang] += n(t)
    read = lambda: {(r.source, r.lang): r.n_tokens for r in store.read().collect()}
    assert read() == dict(want)
    new = token_counts.counted(odd.where("doc_id <> 5").withColumn("text", F.concat("text", F.lit(" more"))), "w", token_counts.words(F.concat("text", F.lit(" more"))))
    new = token_counts.counted(odd.where("doc_id <> 5"), "w", token_counts.words(F.concat("text", F.lit(" more"))))
    assert store.apply("b", token_counts.changes(old, new)) and store.apply("none", token_counts.deletes(old.limit(0)))
    want = Counter()
    for i, t, lang, source, _ in ODD:
        if i is not None and i != 5:
            want[source, lang] += n((t or "") + " more")
    assert read() == dict(want) and store.batches() == ["a", "b", "none"]
    # A second writer that aims at a version which is taken changes nothing and may come again.
    late = token_counts.Rollup(spark, f"file://{tmp_path}/rollup")
    late._last = lambda: 2
    with pytest.raises(RuntimeError):
        late.apply("late", token_counts.inserts(old))
    assert read() == dict(want) and not store.applied("late") and store.batches() == ["a", "b", "none"]
    assert store.apply("late", token_counts.inserts(old)) and store.batches()[-1] == "late"


def test_copies_by_id_and_text(spark):
    rows = [(1, "a"), (2, "a"), (1, "b"), (None, "c"), (None, "c"), (5, "c"), (None, "d"), (None, "d"), (9, "e"), (9, "e"), (7, None)]
    df = spark.createDataFrame([(i, t, "s", "en") for i, t in rows], "doc_id long, text string, source string, lang string")
    kept = token_counts.without_copies(token_counts.measured(df)).collect()
    assert Counter((r.doc_id, r.digest) for r in kept) == Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in [(1, "a"), (1, "b"), (5, "c"), (None, "d"), (None, "d"), (9, "e"), (9, "e")])
    n = spark.createDataFrame([("it's 2 words, naïve…  §",)], "t string").select(token_counts.words("t").alias("a"), token_counts.words_and_marks("t").alias("b")).first()
    assert (n.a, n.b) == (5, 8)


def check_shards(rows, shards, n):
    assert len(rows) == n
    for s in {r.shard for r in rows}:
        assert 0 <= s < shards and sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    size, total = Counter(), sum(r.size for r in rows)
    for r in rows:
        size[r.shard] += r.size
    largest = max((r.size for r in rows), default=0)
    assert all(abs(size[s] - total / shards) <= largest for s in range(shards))


def test_shard_of_the_last_documents(spark):
    for total, last in ((100_000_000_000, 2000), (100_000_000, 3), (1, 1), (10**15, 1)):
        places = spark.createDataFrame([((total - last) * 2 + last,), (0,)], "m long").select(sharding.shard_of(F.col("m"), 16, total).alias("s")).collect()
        assert [r.s for r in places] == [((total - last) * 2 + last) * 16 // (2 * total), 0] and places[0].s < 16


def test_overfull_ranges_are_subdivided(spark):
    # A third of the rows is one short text, which weighs little by bytes.
    df = spark.createDataFrame([(i, "") for i in range(2000)] + [(i, "long text " * 40 + str(i)) for i in range(4000)], "doc_id long, text string")
    rows = sharding.keyed(df)
    n, total = 6000, df.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    largest = lambda cuts: sharding.ranged(rows, cuts).groupBy("range").count().agg(F.max("count")).first()[0]
    assert largest(sharding.splitters(rows, 4, n, total, 100)) <= 400 < largest(sharding.splitters(rows, 4, n, total, 10**6))
    check_shards(sharding.assign(df, 4, rows_per_range=100).collect(), 4, n)


def test_sharding_query(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = sharding.op10_sharding(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    check_shards(rows, 16, len(texts))


def test_sharding_odd_rows(spark, odd, tmp_path):
    rows = sharding.assign(extra(odd, "shard"), 3).collect()
    check_shards(rows, 3, len(ODD))
    hot = spark.createDataFrame([(i % 700, "same") for i in range(2000)] + [(i, f"text {i}") for i in range(500)], "doc_id long, text string")
    check_shards(sharding.assign(hot, 16).collect(), 16, 2500)
    sharding.write_shards(odd.drop("n_chars"), f"{tmp_path}/shards", 3)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(map(str, (tuple(r) for r in back.select("doc_id", "text", "lang", "source").collect()))) == sorted(str(r[:4]) for r in ODD)
    assert sharding.assign(odd.limit(0)).count() == 0


def test_hot_keys_are_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "FEW_ROWS", 10)
    monkeypatch.setattr(common, "HOT_SHARE", 0.05)
    rows = [("hot" if i % 3 else f"k{i}", i) for i in range(600)]
    spark.createDataFrame(rows, "k string, i long").write.parquet(f"{tmp_path}/rows")
    left, right = spark.read.parquet(f"{tmp_path}/rows"), spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, v int")
    hot = common.hot_keys(left.groupBy("k").agg(F.count("*").alias("n")), ["k"])
    assert [(r.k, r["__salts"]) for r in hot.collect()] == [("hot", 14)]
    for how in ("inner", "left"):
        got = common.skew_join(left, right, ["k"], how)
        assert got.columns == ["k", "i", "v"]
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, left.join(right, ["k"], how).collect()))


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://elsewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        common.shared_dir(Session())


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(q.startswith(f"op{i}_") for q in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert json.dumps(entry.oracle_sql())


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_encoder_added_tokens(kind):
    path = token_files.byte_vocabulary() if kind == "byte" else packing.word_vocabulary()
    ours, library = tokens.encoder(path, kind), encoders()[kind]
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids == ([64, 220, 50256, 275] if kind == "byte" else [320, 49407, 321])
    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "word", "É", " ", "  ", "\n", "\t", "\0", "\x1c", ".", "'s", "é", "9", "́"]
    mixed = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    for x in ["a <|endoftext|> b", "x <|startoftext|>\n<|endoftext|>", "<|endoftext|>", "end.<|endoftext|>Start", *mixed]:
        assert np.frombuffer(ours.encode(x), "<u4").tolist() == library.encode(x, add_special_tokens=False).ids, repr(x)


def test_url_filter_scores_are_settled(spark):
    # Two hosts that link to each other: b.io has distrust 0.51 when settled and 0.44 after 12 rounds.
    pages = [(0, "http://a.com/en/1", '<a href="//b.io/">'), *((i, "http://a.com/zz", None) for i in range(1, 6)), (6, "http://b.io/", '<a href="//a.com/">')]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    settled = np.linalg.solve([[1, -url_filter.DAMPING], [-url_filter.DAMPING, 1]], [1 / 6, 0])
    assert [got[1].distrust, got[6].distrust] == pytest.approx(settled.tolist(), abs=1e-7)
    assert got[6].verdict == "block"
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, links long")
    with pytest.raises(RuntimeError):
        url_filter.spread(spark.createDataFrame([("a", 1, 1, 0)], "host string, pages long, allowed long, blocked long"), links, rounds=8)


def test_language_keeps_all_labels(spark):
    rng = random.Random(4)
    words = {f"l{k:03}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(12)] for k in range(150)}
    rows = [(k, " ".join(rng.choices(words[k], k=10))) for k in words for _ in range(4 + (k < "l070"))]
    docs = spark.createDataFrame(rows, "lang string, text string")
    model = language_id.fit(docs)
    assert set(model) == set(words)
    got = language_id.classify(docs, model).collect()
    assert all(r.lang == r.lang_pred for r in got)
    # The groups change nothing.
    sizes = {}
    for lang, content in model.items():
        c = language_id.zstandard.ZstdCompressor(
            dict_data=language_id.zstandard.ZstdCompressionDict(content, dict_type=language_id.zstandard.DICT_TYPE_RAWCONTENT), level=language_id.LEVEL, write_content_size=False
        )
        sizes[lang] = [len(c.compress(language_id.Classifier._data(r.text))) for r in got[:40]]
    order = list(model)
    for i, r in enumerate(got[:40]):
        best, second = sorted((sizes[k][i], order.index(k)) for k in order)[:2]
        assert r.lang_pred == order[best[1]] and r.margin == pytest.approx((second[0] - best[0]) / len(language_id.Classifier._data(r.text)))
