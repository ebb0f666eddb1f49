"""Corpus operators against brute force and exact round trips, with the defined odd cases."""

import hashlib
import random
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("strandloom.llm")
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from strandloom.llm import ann, bpe, exact_dedup, graph, huffman, labelled, packing, quality, queries, simhash, tokens, toxicity, url_filter, warc
from strandloom.llm.runtime import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rid long, kept string"
WORD = "qualm brisk vortex plinth jaunty zephyr cobalt nimbus quartz mirth".split()


def docs(spark, texts, ids=None):
    """Rows with extra columns whose names clash with the operators' own."""
    rows = [(i, t, random.Random(n).choice(["en", "de", None]), None, None if t is None else len(t), 7, "x") for n, (i, t) in enumerate(zip(ids or range(len(texts)), texts))]
    return spark.createDataFrame(rows, DOCS)


ODD = ["", None, " ", "a", "a", "a  b", "a\t\nb", "a b", "x" * 5000, "x" * 4999 + "y", "x" * 5000, "é" * 40, "a b"]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 480)] + [(5, 5), (None, 3)]
    parent = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    df = spark.createDataFrame(edges, "a int, b int")
    got = {r.node: r.component for r in graph.components(df, Scratch(spark, "t")).collect()}
    assert got == {n: root(n) for n in parent}
    assert graph.components(df.where("false"), Scratch(spark, "t")).count() == 0


def test_exact_groups(spark):
    ids = [*range(len(ODD) - 1, 1, -1), None, 0]
    got = exact_dedup.exact_groups(docs(spark, ODD, ids), first_digit=2).collect()
    import re

    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in ODD]
    want = []
    for i, t in zip(ids, norm):
        same = [k for k, u in zip(ids, norm) if u == t]
        keep = min((k for k in same if k is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    kept = exact_dedup.drop_exact_copies(docs(spark, ODD, ids))
    assert kept.columns == [f.split()[0] for f in DOCS.split(", ")]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((w[0] for w in want if w[3]), key=repr)


def test_exact_repeated_rows_and_empty(spark):
    twice = docs(spark, ["same", "same", "other"], [4, 4, 5])
    assert sorted(r.doc_id for r in exact_dedup.drop_exact_copies(twice).collect()) == [4, 5]
    assert exact_dedup.exact_groups(twice.where("false")).count() == 0


def brute_components(prints):
    ids = list(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if bin((prints[a] ^ prints[b]) & (1 << 64) - 1).count("1") <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("crowded", [512, 1])
def test_simhash(spark, crowded):
    rng = random.Random(8)
    base = [" ".join(rng.choices(WORD, k=80)) for _ in range(12)]
    texts = [*ODD[:8], "", *base, *(" ".join([*b.split()[:-1], w]) for b in base for w in WORD[:4])]
    got = {r.doc_id: r for r in simhash.near_groups(docs(spark, texts), crowded=crowded).collect()}
    prints = {i: simhash.fingerprint((t or "").encode()) for i, t in enumerate(texts)}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == {i: p & (1 << 64) - 1 for i, p in prints.items()}
    want = brute_components(prints)
    assert {i: r.component_id for i, r in got.items()} == want
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs(spark, texts)).collect()) == sorted(set(want.values()))


def test_links_between_close_fingerprints(spark):
    rng = random.Random(1)
    prints = {rng.getrandbits(64) - (1 << 63) for _ in range(40)}
    prints |= {p ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for p in list(prints)}
    want = {(a, b) for a in prints for b in prints if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for crowded in (512, 0):
        assert {tuple(r) for r in simhash.links(df, Scratch(spark, "t"), crowded).collect()} == want


TEXTS = [*ODD, "Hello, it's 12 o'clock!  \n\n ok 　 漢字 \U0001f600", "<|endoftext|> x", "end. Mid, \x00 nul \x1c fs", "ab" * 200, " " * 90 + "z", "word. word, Word."]


def fuzz():
    """Short texts of awkward characters, and each character whose lower case or composition has another length, before stops."""
    rng = random.Random(3)
    awkward = "abAB İ.,'s \n\n 19é\u0327\u0301\u030a한漢Σσς😀\t\x0b\x1c\x85\xa0"
    odd = [c for c in map(chr, range(0x11_0000)) if not "\ud800" <= c < "\ue000" and (len(c.lower()) != 1 or len(unicodedata.normalize("NFC", c)) != 1)]
    special = ["<|endoftext|> x", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|><|endoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>.", "word<|endoftext", "\n<|endoftext|>\n\n"]
    return [*("".join(rng.choices(awkward, k=rng.randrange(14))) for _ in range(6000)), *(f"a{c}. {c}, A{c}" for c in odd), "İ.", *special]


@pytest.mark.parametrize("special", [True, False])
@pytest.mark.parametrize(("name", "cut", "kind"), [("word_bpe_49k.json", "words", "<u4"), ("byte_bpe_50k.json", "spaced", "<u2")])
def test_token_ids(monkeypatch, special, name, cut, kind):
    """Against plain calls of the library, with pieces that are new, known, and forgotten."""
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    if not special:
        plain.encode_special_tokens = True
    texts = [*(t or "" for t in TEXTS), *fuzz()]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for cache in (tokens.CACHE, 300):
        monkeypatch.setattr(tokens, "_MADE", {})
        encode = tokens.encoder(path, cut, kind, special, cache)
        for step in (1000, 1000, 37):
            for k in range(0, len(texts), step):
                ids, ends = encode(pa.array(texts[k : k + step], pa.string()))
                assert ids.dtype == np.dtype(kind)
                assert [x.tolist() for x in np.split(ids, ends[:-1])] == want[k : k + step] and ends[-1] == len(ids)
    assert [len(x) for x in encode(pa.array([], pa.string()))] == [0, 0]


def test_packing(spark):
    rng = random.Random(5)
    texts = [*TEXTS, "İ. <|endoftext|>", *(" ".join(rng.choices(WORD, k=rng.choice([5, 300, 900, 2500]))) for _ in range(40))]
    path = public_tokenizers.path("word_bpe_49k.json")
    crc = {"crc": F.crc32("ids"), "own": F.col("ids")}
    got = pd.DataFrame([r.asDict() for r in packing.pack(docs(spark, texts), path, shard=1000, derived=crc).collect()]).sort_values(["sequence_id", "offset"])
    for _, part in got.groupby("sequence_id"):
        assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]] and part["length"].sum() <= 4096
    plain = Tokenizer.from_file(path)
    for i, part in got.sort_values("piece").groupby("doc_id"):
        assert b"".join(part["own"]) == np.array([*plain.encode(texts[i] or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert part["crc"].tolist() == [zlib.crc32(x) for x in part["own"]]
        assert set(part["length"].iloc[:-1]) <= {4096} and part["start"].tolist() == [4096 * k for k in range(len(part))]
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 4096) + 1
    assert packing.pack(docs(spark, []), path).count() == 0


def test_packing_repeated_ids(spark):
    """Null and repeated ids are rows of their own, each with all its pieces."""
    texts = ["one " * 5000, "one " * 5000, "two", "two", None]
    got = packing.pack(docs(spark, texts, [4, 4, None, None, 4]), public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted(((r.doc_id, r.piece, r.length) for r in got), key=repr) == sorted([(4, 0, 4096), (4, 0, 4096), (4, 1, 905), (4, 1, 905), (None, 0, 2), (None, 0, 2), (4, 0, 1)], key=repr)
    assert len({(r.sequence_id, r.offset) for r in got}) == 7


def test_matching_rules():
    rng = random.Random(2)
    for _ in range(50):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(0, 80))]
        bins = packing.matched(lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        for b in bins:
            assert sum(lengths[i] for i in b) <= 100 and sum(3 * lengths[i] > 100 for i in b) <= 2


def test_huffman_code():
    rng = np.random.default_rng(1)
    for n, limit in ((1, 20), (2, 20), (300, 9), (5000, 20)):
        counts = np.zeros(n + 3, np.int64)
        counts[:n] = (rng.pareto(0.5, n) * 3 + 1).astype(np.int64)
        bits = huffman.code_lengths(counts, limit)
        assert bits.max() <= limit and (bits > 0).sum() == n and sum(2.0 ** -bits[bits > 0]) <= 1
        ids = rng.choice(n, 3000)
        payload, marks = huffman.packed(ids, bits, huffman.canonical(bits))
        assert (huffman.unpacked(payload, marks, len(ids), huffman.decode_table(bits, limit), limit) == ids).all()


def test_token_file(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*TEXTS, "a<|endoftext|> b"]
    got = sorted(huffman.round_trip(docs(spark, texts), path).collect())
    plain = Tokenizer.from_file(path)
    start = 0
    for r, t in zip(got, texts, strict=True):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.n, bytes(r.ids)) == (start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert huffman.round_trip(docs(spark, []), path).count() == 0
    odd = huffman.round_trip(docs(spark, ["a b", "c", "c", None], [7, 7, None, None]), path).collect()
    assert sorted(((r.doc_id, r.start, r.n) for r in odd), key=lambda r: r[1]) in ([(None, 0, 2), (None, 2, 1), (7, 3, 3), (7, 6, 2)], [(None, 0, 1), (None, 1, 2), (7, 3, 3), (7, 6, 2)])


def test_byte_bpe(spark):
    rng = random.Random(9)
    made = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks={w: i for i, w in enumerate(made.vocabulary)}, special_tokens={})
    texts = [*TEXTS, *("".join(rng.choices("etaoinshrdlu \n.é", k=rng.choice([3, 40, 300]))) for _ in range(60)), "".join(rng.choices("abcdefgh", k=1500)), " " * 700]
    for most in (1 << 18, 0):
        codec = bpe.Codec(docs(spark, texts), made, most=most)
        got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in codec.decode(codec.encode()).collect()}
        assert got == {i: (plain.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(texts)}


def test_frequent_words(spark):
    """Words that occur once among the drawn rows are folded once, too, the most frequent first where not all are."""
    made = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks={w: i for i, w in enumerate(made.vocabulary)}, special_tokens={})
    df = docs(spark, ["blorfin tanquey tanquey", None, "zembeluk 4711 " + "y" * 60])
    want = {w: plain.encode_ordinary(w) for w in ("blorfin", " tanquey", "zembeluk", " 4711")}
    got = bpe.frequent(df, made, Scratch(spark, "t")).to_pylist()
    assert {r["word"]: r["ids"] for r in got if r["word"] != " "} == want
    assert [r["word"] for r in bpe.frequent(df, made, Scratch(spark, "t"), most=1).to_pylist()] == [" tanquey"]


def test_byte_bpe_work(spark, monkeypatch):
    """A merge copies one array five times, and a plan that encodes and decodes holds the known words once."""
    made = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks={w: i for i, w in enumerate(made.vocabulary)}, special_tokens={})
    copies = []
    for name in ("array_remove", "array_insert"):
        monkeypatch.setattr(F, name, lambda *a, f=getattr(F, name): copies.append(f) or f(*a))
    word = spark.range(1).select(F.lit("blorfin").alias("word"))
    bpe.over(word, made.constants(Scratch(spark, "t"), "bare"), "word", "ids", made.encoded)
    assert 0 < len(copies) <= 5
    rng = random.Random(4)
    edges = ["".join(rng.choices(kind, k=n)) for n in range(bpe.LONG - 2, bpe.LONG + 4) for kind in ("abcdefgh", "a", "etaoin", "\x00\x01!", "é") for _ in range(4)]
    for most in (20, 0):
        codec = bpe.Codec(docs(spark, edges), made, most=most)
        both = codec.decode(codec.encode())
        known = [x for x in (codec.constants, codec.pieces) if "known" in x.columns]
        assert len(known) == 1 and "pieces" not in known[0].columns
        row = known[0].first()
        found = {w: ids for part in row["known"] for w, ids in part.items()}
        assert len(found) <= most and found == {w: plain.encode_ordinary(w) for w in found}
        got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in both.collect()}
        assert got == {i: (plain.encode_ordinary(t), t.encode()) for i, t in enumerate(edges)}
    assert bpe.LONG + 2 <= 1 << bpe.SHORT and made.edge < 1 << (bpe.LOW - bpe.SHORT)


def test_byte_bpe_query(spark, tmp_path):
    """The registered query against tiktoken, with repeated and null ids, and over an empty table."""
    made = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks={w: i for i, w in enumerate(made.vocabulary)}, special_tokens={})
    texts = [*TEXTS, *fuzz()[:3000], "same same", "same same"]
    ids = [*range(len(texts) - 3), None, 5, 5]
    df = docs(spark, texts, ids)
    for name, rows in (("full", df), ("empty", df.where("false"))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    want = []
    for i, t in zip(ids, texts, strict=True):
        raw, found = (t or "").encode(), plain.encode_ordinary(t or "")
        want.append((i, len(found), hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()))
    got = queries.op6_byte_bpe(spark, f"{tmp_path}/full").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert queries.op6_byte_bpe(spark, f"{tmp_path}/empty").count() == 0


def test_warc(spark):
    big = "ä" * 600_000
    rows = [(5, "http://a/ b\r\nX: y", big), (2, None, big), (3, "u", "short"), (4, "u", "short"), (7, "u", None), (9, "u", "\r\n\r\n" * 40), (9, "u", "\r\n\r\n"), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    chunks = Scratch(spark, "t").save(warc.archive(pages), "a")
    assert chunks.agg(F.max(F.octet_length("data"))).first()[0] <= warc.CHUNK
    got = sorted(((r.page and int(r.page), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in warc.records(chunks).collect()), key=repr)
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        revisit = html == big and page != 2
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None))
    assert got == sorted(want, key=repr)
    broken = chunks.withColumn("data", F.when(F.col("chunk") == 2, F.lit(b"zz")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="broken|early"):
        warc.records(broken).collect()


def test_url_rules(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    link = '<link href="{}" rel=canonical>'
    rows = [
        (1, "http://A.Example.NET/en/x", "", "allow", "example.net/en/"), (2, "https://x.net/", None, "block", "net/"), (3, "http://x.net", "", "allow", None),
        (4, "http://notnet/", "", "allow", None), (5, None, link.format("http://x.net/"), "allow", None), (6, "no scheme", "", "allow", None),
        (7, "http://q.io/a#f", link.format("//x.net/z"), "block", None), (8, "http://q.io/b", '<meta http-equiv="refresh" content="0; url=/a">', "block", None),
        (9, "http://r.io/a", link.format("http://x.net/") , "allow", None), (10, "http://r.io/b", link.format("http://r.io/a"), "allow", None),
        (11, "http://s.org/fr/?q", link.format("http://r.io/a"), "allow", "org/fr/"), (12, "http://example.com/de/k?x", link.format("http://s.org/fr/"), "block", "example.com/de/"),
        (2, "https://x.net/", None, "block", "net/"),
    ]
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://s.org/fr/?q", "http://r.io/b")], "from_url string, to_url string")
    got = sorted((r.page_id, r.verdict, r.rule) for r in url_filter.judge(pages, rules, redirects=redirects).collect())
    assert got == sorted((r[0], r[3], r[4]) for r in rows)
    first = url_filter.judge(pages, rules).where("page_id = 1").first()
    assert (first.host, first.path) == ("a.example.net", "/en/x")


def test_refresh_targets(spark):
    refresh = '<meta http-equiv="refresh" content={}>'
    cases = {
        "http://q.io/t?p=1&q=2": '"0; url=http://q.io/t?p=1&amp;q=2"', "http://q.io/t?p=1&q=3": "'5;URL=/t?p=1&#38;q=&#x33;'",
        "http://q.io/s;jsessionid=7?a;b": '"0;url=/s;jsessionid=7?a;b"', "http://q.io/u;v": "0;url=/u;v", "http://q.io/w;x>y": "\"0; url='/w;x>y' \"",
        "http://q.io/no?a=1&copy=2&zz;\U0001f600é": '"3 , http://q.io/no?a=1&copy=2&zz;&#x1F600;&eacute;"', "http://q.io/long" + "k" * 300_000: '"0; url=/long' + "k" * 300_000 + '"',
    }
    pages = [(n, f"http://from.io/{n}" if "//q.io" in v else f"http://q.io/{n}", refresh.format(v)) for n, v in enumerate(cases.values())]
    pages += [(99, "http://q.io/none", refresh.format('"5"')), (98, "http://q.io/bad", refresh.format('"0; url=&#xD800;&#0;&#99999999;"'))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.a: r.b for r in url_filter.link_edges(df).where("b is not null and a <> 'http://q.io/bad'").collect()} == {p[1]: u for p, u in zip(pages, cases)}
    ends = [(k, u, "<link rel=canonical href=http://x.net/>") for k, u in enumerate(cases, 100)]
    both = df.union(spark.createDataFrame(ends, df.schema))
    got = {r.page_id: r.verdict for r in url_filter.judge(both, [("block", "net", "/")]).collect()}
    assert got == {p[0]: "allow" if p[0] in (98, 99) else "block" for p in pages + ends}


def test_relative_links(spark):
    page, link, refresh = "http://a/b/c/d;p?q", '<link rel="{}" href="{}">', '<meta content="0;url={}" http-equiv=Refresh>'
    want = {
        "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y#s": "http://a/b/c/g?y",
        ";x": "http://a/b/c/;x", ".": "http://a/b/c/", "..": "http://a/b/", "../..": "http://a/", "../../../g": "http://a/g", "/./g": "http://a/g", "..g": "http://a/b/c/..g",
        "g/../h?x=../y": "http://a/b/c/h?x=../y", "go?to=http://z/": "http://a/b/c/go?to=http://z/", "HTTP://X.Net/A/./B": "http://x.net/A/B", "mailto:x": None, "#s": None, "": None,
    }
    html = "".join(link.format("nofollow Canonical", k) if n % 2 else refresh.format(k) for n, k in enumerate(want))
    based = '<BASE href="../e/"><link data-href=no rel=canonical href=g><link rel=stylesheet href=css>'
    rows = [(1, page, html), (2, "http://h", refresh.format("g")), (3, "http://h/x/y", based)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {tuple(r) for r in url_filter.link_edges(df).where("b is not null").collect()}
    assert got == {(page, u) for u in want.values() if u} | {("http://h", "http://h/g"), ("http://h/x/y", "http://h/e/g")}
    rows = [
        (1, "http://Q.io/f/a", link.format("canonical", "http://other.io/") + link.format("canonical", "b")), (2, "http://q.io/f/b", refresh.format("?id=1")), (3, "http://q.IO/f/b?id=1", refresh.format("5") + refresh.format("../c")),
        (4, "http://q.io/f/../c", link.format("canonical", "http://X.net/")), (5, "http://q.io/d", None),
    ]
    pages = spark.createDataFrame(rows, df.schema)
    redirects = spark.createDataFrame([("http://q.io/d", "f/a")], "from_url string, to_url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, [("block", "net", "/")], redirects=redirects).collect()}
    assert got == dict.fromkeys(range(1, 6), "block")


def test_search(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 16)) * 0.4
    x[1000:1400] = x[1000]  # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1500, None), (1501, [0.0] * 16), (1502, [float("nan")] * 16), (1503, [None] * 16), (1504, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") % 100 == 0, k=10, block=256).collect()
    hits = 0
    for q in range(0, 1500, 100):
        score = ann.scores(np.repeat(x[q : q + 1], len(x), 0), x)
        true = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:10]
        mine = [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
        assert len(mine) == 10 and all(s == score[i] for i, s in mine) and mine == sorted(mine, key=lambda m: (-m[1], m[0]))
        hits += len(set(true) & {i for i, _ in mine})
    assert hits >= 0.9 * 150 and {r.query_id for r in got} == set(range(0, 1500, 100))
    few = ann.search(df.where("vec_id < 5"), F.col("vec_id") >= 0)
    assert few.count() == 20 and ann.search(df.where("false"), F.lit(True)).count() == 0


def test_search_odd_rows(spark):
    """Repeated ids, other lengths, and leaves that are split again, against brute force."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    x = [(centres[rng.integers(0, 12)] + rng.normal(size=8) * 0.3).tolist() for _ in range(900)] + rng.normal(size=(30, 5)).tolist()
    ids = [*range(900), *range(900, 930)]
    x += [x[100], x[200], x[0], x[905]]
    ids += [100, 3, 0, 910]
    rows = list(zip(ids, x))
    df = spark.createDataFrame([*rows, (None, x[0])], "vec_id long, embedding array<double>").repartition(3)
    got = ann.search(df, F.col("vec_id") % 10 == 0, k=5, sample=200, block=128).collect()
    mine, want, hits = {}, {}, 0
    for q, v in rows:
        if q % 10 == 0:
            seen = False
            near = []
            for i, u in rows:
                if not seen and (i, u) == (q, v):  # its own row
                    seen = True
                elif len(u) == len(v):
                    near.append((-sum(a * b for a, b in zip(u, v)), i))
            want.setdefault(q, []).append([i for _, i in sorted(near)[:5]])
    for r in got:
        mine.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    for q, lists in want.items():
        assert sorted(k for k, _ in mine[q]) == sorted(list(range(1, 6)) * len(lists))
        found = [i for _, i in mine[q]]
        hits += sum(min(found.count(i), sum(lists, []).count(i)) for i in set(found))
    assert set(mine) == set(want) and hits >= 0.9 * 5 * sum(map(len, want.values()))
    assert all(sorted(i for _, i in mine[q]) == sorted(sum(want[q], [])) for q in want if q >= 900)  # of another length: exact


def test_sum_of_squares_identity():
    rng = np.random.default_rng(2)
    model = quality.Machine(np.zeros((17, quality.BINS - 1)), 0.3, rng.normal(size=quality.WORDS + 17 * quality.BINS), rng.normal(size=(quality.WORDS + 17 * quality.BINS, 3)))
    row = quality.features("a b b c\nd", 9)
    index, value, _ = model.sparse([row])
    pairs = sum(model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j] for i in range(len(index)) for j in range(i))
    assert np.isclose(model.logits([row])[0], 0.3 + model.linear[index] @ value + pairs)


def corpus(spark):
    rng = random.Random(7)
    texts, marks = [], []
    for i in range(500):
        words = rng.choices(WORD, k=rng.randrange(20, 90))
        good, toxic = i % 5 > 0, i % 3 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["grumblefoo", "snarkbar"])
        texts.append(" ".join(words) if good else " ".join(w.upper() + "!!" for w in words))
        marks.append((i, int(good), int(toxic)))
    extra = ["", None, "the end", "ä" * 50_000]
    return docs(spark, texts + extra), spark.createDataFrame([*marks, (3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_classifiers(spark):
    df, labels = corpus(spark)
    truth = {r.doc_id: (r.quality, r.toxic) for r in labels.where("doc_id < 500 and toxic is not null").collect()}
    for module, k, divisor, held in ((quality, 0, 4, 2), (toxicity, 1, 5, 0)):
        model = module.train(df, labels, labelled.remainder("doc_id", divisor) != held)
        got = {r.doc_id: r for r in module.score(df, model).collect()}
        assert len(got) == 504 and all(0 <= r.score <= 1 for r in got.values())
        test = [i for i in truth if zlib.crc32(str(i).encode()) % divisor == held]
        assert np.mean([got[i].predicted == truth[i][k] for i in test]) >= 0.95
        assert {r.score for r in module.score(df, None).collect()} == {0.5 if module is quality else 0.0}
        assert module.score(df.where("false"), model).count() == 0
    assert toxicity.train(df, labels.where("toxic = 1"), F.lit(True)) is None
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and 250 < kept.count() < 400


def test_language_cuts(spark):
    rng = np.random.default_rng(6)
    bins, y = rng.integers(-90, 90, 400), rng.random(400) < 0.4
    table = pd.DataFrame({"bin": bins, "clean": ~y, "toxic": y}).groupby("bin").sum().reset_index().sample(frac=1, random_state=1)
    cut = toxicity.best_cut(*(table[c].to_numpy(np.float64) for c in table), (1.0, 2.5))
    logit = np.log(cut / (1 - cut)) * (y.sum() + 30) / y.sum()
    loss = lambda c: 2.5 * (y & ((bins + 0.5) / toxicity.BINS < c)).sum() + (~y & ((bins + 0.5) / toxicity.BINS >= c)).sum()
    assert loss(logit) == min(loss(c / toxicity.BINS) for c in range(-91, 92))
    df, labels = corpus(spark)
    df = df.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    model = toxicity.train(df, labels, F.lit(True), rows={1: 6, 0: 10})  # a fifth of the drawn has one toxic row
    assert set(model.cuts) == {"en", "de"}
    few = toxicity.train(df, labels, F.lit(True), rows={1: 4, 0: 4})  # every drawn row is fitted, so none sets the scale
    assert few.scale == (1.0, 0.0) and set(few.cuts) == {"en", "de"}
    all_fitted = toxicity.train(df, labels, F.col("doc_id").isin(0, 1, 2, 3, 4, 6), rows={1: 4, 0: 4})
    assert all_fitted.scale == (1.0, 0.0) and all_fitted.cuts == {}


def test_long_labelled_texts(spark, monkeypatch):
    df = docs(spark, ["word " * 60_000, "b", None])
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    drawn = labelled.sample(df, labels, "toxic", F.lit(True), {1: 5, 0: 5}).collect()
    assert sorted((r.doc_id, len(r.text), r.y) for r in drawn) == [(0, 300_000, 1), (1, 1, 0), (2, 0, 0)]
    rng = random.Random(4)
    rows = [toxicity.words(" ".join(rng.choices(WORD, k=k))) for k in (0, 1, 2, 3, 9, 40, 41, 42, 43, 90)]
    whole = toxicity.fit(rows, np.arange(10) % 2, epochs=2)
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    parts = toxicity.fit(rows, np.arange(10) % 2, epochs=2)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(whole.tables, parts.tables, strict=True)) and np.allclose(whole.out, parts.out)


def test_pipeline_runs(spark, tmp_path):
    import corpus_pipeline

    df, labels = corpus(spark)
    for name, (d, y) in {"full": (df, labels), "empty": (df.where("false"), labels)}.items():
        d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        y.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    full = corpus_pipeline.run(spark, f"{tmp_path}/full")
    kept = {r.doc_id for r in full.collect()}
    clean = {i for i in range(500) if i % 5 and i % 3}
    assert len(kept & clean) >= 0.95 * len(clean) and len(kept - clean) <= 30
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_scope(spark):
    from pathlib import Path

    from strandloom.llm import runtime

    folder = Path(runtime.shared_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    with runtime.scope(spark):
        assert exact_dedup.drop_exact_copies(docs(spark, ["a", "a", "b"])).count() == 2 and set(folder.iterdir()) > before
    assert set(folder.iterdir()) == before


def test_repeated_training_ids(spark):
    """An id that repeats is learned from once, with one row's text and metadata."""
    df = docs(spark, [f"text {i}" for i in range(100)] + ["other"] * 5, [7] * 100 + [8] * 5)
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0), (8, 0)], "doc_id long, quality int")
    also = {"stated": F.col("n_chars")}
    got = labelled.sample(df, labels, "quality", F.lit(True), {1: 50, 0: 50}, also=also).collect()
    assert sorted((r.doc_id, r.y, r.stated == len(r.text)) for r in got) == [(7, 1, True), (8, 0, True)]
    again = labelled.sample(df.repartition(5), labels, "quality", F.lit(True), {1: 50, 0: 50}, also=also).collect()
    assert sorted(r.text for r in again) == sorted(r.text for r in got)
    assert quality.train(df, labels, F.lit(True)) is not None


def test_machine_and_network_against_plain_sums():
    """Logits of many rows against sums over all pairs, and pooled values against windows one by one."""
    rng = np.random.default_rng(8)
    size = quality.WORDS + 17 * quality.BINS
    model = quality.Machine(rng.normal(size=(17, quality.BINS - 1)).cumsum(1), 0.1, rng.normal(size=size), rng.normal(size=(size, quality.RANK)))
    words = random.Random(2)
    rows = [quality.features(" ".join(words.choices(WORD, k=k)), stated) for k, stated in ((0, None), (1, 4), (7, 50), (60, 400), (300, 9))]
    index, value, starts = model.sparse(rows)
    for got, a, b in zip(model.logits(rows), starts, [*starts[1:], len(index)], strict=True):
        x = model.factors[index[a:b]] * value[a:b, None]
        pairs = sum(float(x[i] @ x[j]) for i in range(len(x)) for j in range(i))
        assert np.isclose(got, 0.1 + model.linear[index[a:b]] @ value[a:b] + pairs)
    net = toxicity.fit([toxicity.words(" ".join(words.choices(WORD, k=9))) for _ in range(12)], np.arange(12) % 2, epochs=1)
    tables = [t for t in net.embedded]
    for k in (3, 4, 11, 40):
        seen = toxicity.words(" ".join(words.choices(WORD, k=k)))
        x = np.concatenate([t[at] for t, at in zip(tables, toxicity.buckets(seen), strict=True)], axis=1)
        plain = [max(sum(float(x[s + j] @ f[j][:, c]) for j in range(len(f))) for s in range(k - len(f) + 1)) for f in net.filters for c in range(toxicity.FILTERS)]
        assert np.allclose(net.pooled(seen), plain, atol=1e-4)


def test_processes_of_a_saved_table(spark, tmp_path):
    """Java starts a process for a file's permissions, which has the JVM's whole memory until it runs: one a file, none for checksums."""
    df = docs(spark, [f"some words {i}" for i in range(40)]).repartition(4)
    recording = spark._jvm.jdk.jfr.Recording()
    recording.enable("jdk.ProcessStart")
    recording.start()
    saved = Scratch(spark, "t").save(df, "rows")
    recording.stop()
    dump = spark._jvm.java.nio.file.Path.of(f"{tmp_path}/starts.jfr", spark._sc._gateway.new_array(spark._jvm.String, 0))
    recording.dump(dump)
    recording.close()
    started = [e.getString("command") for e in spark._jvm.jdk.jfr.consumer.RecordingFile.readAllEvents(dump)]
    assert len([c for c in started if "/part-" in c]) == len(saved.inputFiles()) == 4
    assert not [c for c in started if ".crc" in c]
    assert saved.count() == 40


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_copies, simhash.drop_near_copies])
def test_processes_of_stored_documents(spark, tmp_path, drop):
    """Documents read from files aren't copied, and what is kept of each row starts no process."""
    from strandloom.llm import runtime

    texts = [f"{'the same start of all texts here, ' * 3} text {i // 2} of {i // 2} {'more words ' * (i // 2 % 7)}" for i in range(200)] + [None, ""]
    docs(spark, texts).repartition(6).write.parquet(f"{tmp_path}/docs")
    stored = spark.read.parquet(f"{tmp_path}/docs")

    def persisted():
        return set(spark.sparkContext._jsc.getPersistentRDDs())

    want = sorted(r.doc_id for r in drop(stored).collect())
    before = persisted()
    recording = spark._jvm.jdk.jfr.Recording()
    recording.enable("jdk.ProcessStart")
    recording.start()
    with runtime.scope(spark):
        made = drop(stored, stored=True)
        recording.stop()
        got = made.collect()
        assert persisted() > before
    assert persisted() == before
    dump = spark._jvm.java.nio.file.Path.of(f"{tmp_path}/starts.jfr", spark._sc._gateway.new_array(spark._jvm.String, 0))
    recording.dump(dump)
    recording.close()
    started = [e.getString("command") for e in spark._jvm.jdk.jfr.consumer.RecordingFile.readAllEvents(dump)]
    assert started and not [c for c in started for table in ("numbered", "lite", "marked") if f"/{table}" in c]
    assert sorted(r.doc_id for r in got) == want and made.columns == stored.columns
    assert len({r.doc_id for r in got}) == len(got) < len(texts)
