"""The training-data operators on small fixtures, against SQL or brute force."""

import hashlib
import html as html_module
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from panelspark.llm import (
    chat, decontam, html, langid, lines, packing, quality, simhash, substrings, urls,
)
from panelspark.llm.queries import ORACLE_SQL, QUERIES, line_sql, quality_sql, tokenizer_path
from panelspark.plans.registry import REGISTRY

SMALL = "/root/testdata/sf0.001"
NAMES = "documents pages benchmark labels conversations".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, N_WORDS int, kept int"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in NAMES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return connection


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, empty and long texts, ties, repeated rows and columns that clash with results."""
    long = " ".join(f"word{i % 977}x" for i in range(30_000)) + ".\n" + "again. " * 500
    rows = [
        (1, None, None, None, None, None, None),
        (2, "", "en", "a", 0, 1, 1),
        (None, "No id here, but text enough.", "en", None, 3, 1, 1),
        (None, "No id here, but text enough.", "en", None, 3, 1, 1),
        (3, long, "en", "a", len(long), 1, 1),
        (3, long, "en", "a", len(long), 1, 1),
        (4, long, "en", "b", len(long), 1, 1),
        (5, " ".join(f"ünï{c}code É{c}É 日本{c}" for c in "abcdefghij"), "fr", "b", 1, 1, 1),
        (6, " \n\t\n ", "de", "b", 1, 1, 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    expected = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in places) for r in expected.fetchall()), key=str)
    assert rows_of(df.select(*columns)) == want


def test_names_do_not_clash():
    assert not set(QUERIES) & set(REGISTRY)
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES} == set(range(1, 14))


# ---- 1 --------------------------------------------------------------------------------


def plain(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(text, items):
    words = plain(text)
    hit, found = [False] * len(words), set()
    for item, body in items:
        own = plain(body)
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1) if own else ():
            if tuple(words[i : i + size]) in windows:
                hit[i : i + size] = [True] * size
                found.add(str(item))
    return len(words), sum(hit), sorted(found)


def test_long_items_are_cut_with_whole_windows():
    words = [f"w{i}" for i in range(97)]
    pieces = list(decontam._pieces(" - ".join(words), 30, 13))
    windows = {tuple(words[i : i + 13]) for i in range(85)}
    cut = [p.split(" ") for p in pieces]
    assert len(pieces) > 3 and max(map(len, cut)) <= 30 and min(map(len, cut)) >= 13
    assert {tuple(p[i : i + 13]) for p in cut for i in range(len(p) - 12)} == windows
    assert list(decontam._pieces("a b", 30, 13)) == ["a b"]


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    """With a hash of one bit every window collides; the sets stay right."""
    plain_hashes = decontam.window_hashes
    monkeypatch.setattr(decontam, "window_hashes",
                        lambda h, n: plain_hashes(h, n) & np.uint64(1))
    rng = random.Random(4)
    items = [(i, " ".join(rng.choices("abc", k=rng.choice([1, 2, 13, 15])))) for i in range(30)]
    texts = [" ".join(rng.choices("abc", k=30)) for _ in range(20)] + [t for _, t in items]
    import pyarrow as pa

    known = decontam.window_set(items, 13)
    got = list(decontam.scan(pa.array(texts), known, decontam._lowered()))
    assert [(n, h, i) for n, h, i, _ in got] == [brute_hits(t, items) for t in texts]


@pytest.mark.parametrize("block_words", [decontam.BLOCK_WORDS, 40, 14])
def test_decontamination_equals_brute_force(spark, odd, block_words):
    rng = random.Random(3)
    words = ["alpha", "Beta", "γάμμα", "d4", "e"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 13, 14, 20]))))
             for i in range(12)] + [(50, None), (7, "Beta d4")]
    texts = [" ".join(rng.choices(words, k=40)) + rng.choice(["", "\n", " - "]) for _ in range(20)]
    texts += [None, "", "--", items[3][1], "x" * 50]
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.find(docs, bench, block_words=block_words)
    for r in found.collect():
        want = brute_hits(r["text"], items)
        assert (r["n_words"], r["n_hit"], r["items"]) == want
        covered = sum(len(plain(r["text"][s["start"] : s["end"]])) for s in r["spans"])
        assert covered == r["n_hit"]
    cut = {r["doc_id"]: r["text"] for r in decontam.remove_spans(found).collect()}
    assert cut[23] == "" or not items[3][1]
    assert decontam.find(odd, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.find(odd, bench).count() == odd.count()
    assert found.where("n_hit = 0").count() == decontam.remove_documents(found).where(
        "n_hit = 0").count()


# ---- 2 --------------------------------------------------------------------------------


def test_common_lines_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = (
                    table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j]))
        found = html.common_lines(a, b)
        assert len(found) == table[-1][-1]
        rest = iter(b)
        assert all(a[i] in rest for i in sorted(found))


def test_extraction_of_marked_and_unmarked_pages(spark):
    page = ("<html><head><title>t</title></head><body><div>Site name</div><nav>menu</nav>"
            "<div class='cookie-notice'>cookies</div><div class='text'><h1>Head {0}</h1>"
            "<p>Body <b>of</b> page {0} &amp; more<br>line {0}<script>x('</p>')</script></div>"
            "<section id=comments><p>first</p></section><form>f</form><aside>s</aside>"
            "<footer>&copy; site</footer></body></html>")
    rows = [(i, f"http://h.org/p/{i}", page.format(i)) for i in range(4)]
    rows += [(10, None, None), (11, "x", ""), (12, "http://h.org/a",
             "<article><header><h1>T</h1></header>a < b&nbsp;c<div class=ad>buy</div></article>z")]
    got = {r["page_id"]: r for r in html.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1]["text"] == "Head 1 Body of page 1 & more line 1"
    assert got[12]["text"] == "T a < b c" and got[12]["n_chars"] == 9
    assert got[10]["text"] == "" and got[11]["text"] == "" and got[10]["n_chars"] == 0
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")
                        ).count() == 0


def test_long_repeated_and_clashing_pages(spark):
    words = [f"word {i}" for i in range(30_000)]
    body = "<p>" + "</p><p>".join(words) + "</p>"
    marked, bare = f"<nav>m</nav><article>{body}</article>", f"<div>{body}</div>"
    rows = [(1, "http://h/1", marked), (1, "http://h/1", marked), (2, "http://h/2", bare),
            (None, None, "<p>x")]
    pages = spark.createDataFrame(
        [(*r, "t", 1, "h", 2, "k") for r in rows],
        "page_id long, url string, html string, TEXT string, n_chars int, host string, path int,"
        " page_key string")
    got = html.extract(pages)
    assert got.columns == ["page_id", "url", *html.ADDED]
    assert sorted((str(r["page_id"]), r["text"]) for r in got.collect()) == sorted(
        [("1", " ".join(words))] * 2 + [("2", " ".join(words)), ("None", "x")])


def test_extraction_returns_the_articles(spark):
    for r in QUERIES["op2_html_extraction"](spark, SMALL).join(
        spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        body = re.sub(r"</?b>", "", re.sub(r"</?(p|br|h1)>", " ", body))
        assert r["text"] == " ".join(html_module.unescape(body).split())


@pytest.mark.parametrize("page, text", [
    ("<form id='page'><div><article>In a form</article></div></form>x", "In a form"),
    ("<form><nav>n</nav><main>Main <form>f</form>text</main></form>", "Main text"),
    ("<article><p data-x=it's>one</p> two <p title='a>b' id=c>three</p></article>", "one two three"),
    ("<article>a <div class='share price table'>Prices of shares</div></article>",
     "a Prices of shares"),
    ("<article>a <div class='share'>tell</div><div class=\"ad-box left\">buy</div> b</article>", "a b"),
    ("<div class='layout no-sidebar'><article>With a layout</article></div>", "With a layout"),
    ("<div class='related'><article>teaser</article></div><article>real</article>", "real"),
    ("<aside><article>teaser</article></aside><div class='sidebar-wrap'><main>real</main></div>", "real"),
    ("<article>text<article class=comment>c</article></article>", "text"),
    ("<article hidden>no</article><article>yes<div aria-hidden=true>no</div></article>", "no yes"),
])
def test_what_holds_the_article_does_not_lose_it(page, text):
    lines, has_article = html.read_lines(page)
    assert has_article and " ".join(t for t, inside, gone, _ in lines if inside and not gone) == text


def test_doubtful_blocks_go_where_neighbours_share_them(spark):
    body = ("<article><h1>T{0}</h1><div class='share price table'>Price {1}</div>"
            "<div class='share our story'>Tell your friends</div><p>Text {0}</p></article>")
    rows = [(i, f"http://h.org/{i}", body.format(i, i * i), 1) for i in range(5)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, N_CHARS int"))
    assert {r["page_id"]: r["text"] for r in got.collect()} == {
        i: f"T{i} Price {i * i} Text {i}" for i in range(5)}


def test_differencing_equals_brute_force(spark, monkeypatch):
    """Unmarked pages of several hosts: lines that the page before or after has too go."""
    monkeypatch.setattr(html, "PAGES_PER_PART", 5)
    rng = random.Random(12)
    rows = []
    for h in range(4):
        for i in range(25):
            lines = [f"Site {h}", *(["Sign in"] if i % 3 else []), f"Own {h} {i} {rng.random()}",
                     *([f"Season {i // 4}"] if i % 2 else []), f"More {rng.random()} of {i}", "Imprint"]
            rows.append((h * 100 + i, f"http://h{h}.org/{i:03}", "".join(f"<div>{x}</div>" for x in lines)))
    rows.append((999, "http://h0.org/010", "x" * 300_000))
    got = {r["page_id"]: r["text"] for r in html.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    sites = {}
    for i, u, page in rows:
        host, path = u[7:].split("/")
        sites.setdefault(host, []).append((path, i, re.findall("<div>(.*?)</div>", page) or [page]))
    for pages in sites.values():
        pages.sort(key=lambda p: (p[0], str(p[1])))
        for k, (_, i, lines) in enumerate(pages):
            near = [pages[j][2] for j in (k - 1, k + 1) if 0 <= j < len(pages)]
            assert got[i] == " ".join(x for x in lines if not any(x in n for n in near))


def test_copies_and_part_borders_leave_neighbours(spark, monkeypatch):
    page = "<body><div>Site {0}</div><div>About us</div><p>Story {0} {1} with words of its own</p></body>"

    def rows(n, copies):
        return [(i * copies + c, f"http://h.org/{i:04}?m={c}", page.format("name", i))
                for i in range(n) for c in range(copies)]

    def texts(pages):
        return {r["page_id"]: r["text"] for r in html.extract(
            spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}

    for parts, n, copies in ((64, 6, 3), (1, 40, 1), (1, 30, 2), (2, 12, 7)):
        monkeypatch.setattr(html, "PAGES_PER_PART", parts)
        pages = rows(n, copies)
        got = texts(pages)
        assert len(got) == len(pages)
        for i in range(n):
            for c in range(copies):
                assert got[i * copies + c] == f"Story name {i} with words of its own"
    monkeypatch.setattr(html, "PAGES_PER_PART", 64)
    alone = texts([(i, "http://h.org/a", page.format("x", 1)) for i in range(3)])
    assert set(alone.values()) == {"Site x About us Story x 1 with words of its own"}


def test_context_passes_over_parts_of_copies():
    def row(part, side, key, alone=False, seen=None):
        return {"part": part, "host": "h", "path": "/", "side": side, "page_key": key, "alone": alone,
                "hashes": seen and list(seen), "chars": seen and list(seen.values())}

    borders = [row(0, s, s + "0") for s in ("first", "second", "previous", "last")]
    for part in range(1, 5):
        borders += [row(part, s, f"{s}{part}", True, {7: 50}) for s in ("first", "last")]
    borders += [row(5, s, s + "5") for s in ("first", "second", "previous", "last")]
    sent = html._context(borders)
    of = {p: {k[2] for k, parts in sent.items() if p in parts} for p in range(6)}
    assert of[5] == {"last4", "last0", "previous0"}
    assert of[3] == {"last2", "last0", "previous0", "first4", "first5", "second5"}
    assert of[0] == {"first1", "first5", "second5"}


# ---- 3 --------------------------------------------------------------------------------


def check_packing(pieces, ids, size=2048):
    """Pieces as (doc, start, length, ids, doc_tokens, sequence, offset)."""
    whole = {}
    for doc, start, length, octets, n, _, _ in pieces:
        part = np.frombuffer(octets, "<u4").tolist()
        assert len(part) == length and n == len(ids[doc])
        assert part == ids[doc][start : start + length]
        whole.setdefault(doc, []).append((start, length))
    assert whole.keys() == ids.keys()
    for doc, parts in whole.items():
        ends = [s + n for s, n in sorted(parts)]
        assert [0, *ends] == [*(s for s, _ in sorted(parts)), len(ids[doc])]
    windows = {}
    for p in pieces:
        windows.setdefault(p[5], []).append((p[6], p[2]))
    for parts in windows.values():
        parts.sort()
        assert [0, *np.cumsum([n for _, n in parts])][:-1] == [o for o, _ in parts]
    lengths = [sum(n for _, n in w) for w in windows.values()]
    assert all(n == size or n & (n - 1) == 0 for n in lengths)
    return lengths


def test_packing_places_every_id_once(spark):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r["doc_id"]: coder.encode(r["text"], add_special_tokens=False).ids + [1]
           for r in docs.collect()}
    pieces = [tuple(r) for r in packing.pack(docs, tokenizer_path()).collect()]
    lengths = check_packing(pieces, ids)
    assert lengths.count(2048) == sum(map(len, ids.values())) // 2048
    of = {r["doc_id"]: r["source"] for r in docs.collect()}
    total, share = sum(map(len, ids.values())), {}
    for i, s in of.items():
        share[s] = share.get(s, 0) + len(ids[i])
    for w in range(len(lengths) // 2):
        got = {}
        for p in pieces:
            if p[5] == w:
                got[of[p[0]]] = got.get(of[p[0]], 0) + p[2]
        for s, n in share.items():
            assert abs(got.get(s, 0) - 2048 * n / total) <= 12
    query = QUERIES["op3_packing"](spark, SMALL).collect()
    assert {(r["doc_id"], r["start"], r["ids_crc32"]) for r in query} == {
        (p[0], p[1], zlib.crc32(p[3])) for p in pieces}


def test_packing_follows_targets_and_takes_odd_rows(spark, odd, none):
    assert packing.pack(none, tokenizer_path()).count() == 0
    pieces = packing.pack(odd, tokenizer_path()).collect()
    assert sum(r["length"] for r in pieces if r["doc_id"] == 1) == 1
    lengths = {}
    for r in pieces:
        lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values())
    rows = [(i, "word " * 400, "ab"[i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, tokenizer_path(), targets={"a": 3, "b": 1}, size=100).collect()
    first = [r for r in pieces if r["sequence_id"] < 80]
    assert sum(r["length"] for r in first if r["doc_id"] % 2 == 0) == 6000
    check_packing([tuple(r) for r in pieces], {
        i: np.frombuffer(b"".join(r["ids"] for r in sorted(
            (r for r in pieces if r["doc_id"] == i), key=lambda r: r["start"])), "<u4").tolist()
        for i in range(40)}, size=100)


def test_many_small_sources_keep_their_share(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_SOURCES", 100)
    rows = [(2 * s + i, "word " * (60 + s % 40), None if s == 7 else f"host{s}")
            for s in range(1500) for i in (0, 1)]
    rows += [(5000 + i, "word " * 3000, "hot") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    pieces = [tuple(r) for r in packing.pack(docs, tokenizer_path(), size=512).collect()]
    ids = {}
    for p in sorted(pieces):
        ids.setdefault(p[0], []).extend(np.frombuffer(p[3], "<u4").tolist())
    check_packing(pieces, ids, size=512)
    total = sum(map(len, ids.values()))
    for share in (0.25, 0.5, 0.75):
        upto = int(total * share) // 512
        sent = {}
        for p in pieces:
            s = p[0] // 2 if p[0] < 5000 else "hot"
            sent[s] = sent.get(s, 0) + (p[2] if p[5] < upto else 0)
        for s, n in sent.items():
            whole = 2 * len(ids[2 * s]) if s != "hot" else 20 * 3001
            assert abs(n - whole * upto * 512 / total) <= 14


def test_targets_of_small_sources_are_honoured(spark):
    rows = [(i, "word " * 3000, "big") for i in range(80)]
    rows += [(100 + i, "word " * 9, f"s{i % 20}") for i in range(200)]
    rows += [(1000 + i, "word " * 9, "tiny") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, tokenizer_path(), targets={"tiny": 1, "big": 3}, size=100).collect()
    got = [sum(r["length"] for r in pieces if r["sequence_id"] == w and r["doc_id"] >= 1000)
           for w in range(4)]
    assert got == [25, 25, 25, 25]
    for wrong in ({"tiny": 0}, {"tiny": 0.5}, {"tiny": 1, "nobody": 2}):
        with pytest.raises(ValueError):
            packing.pack(docs, tokenizer_path(), targets=wrong)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_are_tokenized_as_whole_texts(name):
    """By the plain library: strings of special tokens are those tokens, and a tokenizer whose
    pieces hold the space before them is not taken apart at spaces."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path(name))
    texts = ["It's the ΣΣ end", "a,b c.\n", "x\u00a0y", "ﬁn ＡＢ e\u0301té E\u0301", "İstanbul I",
             "3.14, '' 's foo's. foo'.", "<|endoftext|> a", "\x1c\x85 z.", "日本語 한국어 ا ـ",
             "don't. DON'T! a's, ", "ǅ ǆ ß ẞ", None, "", "  ", "$. a$. é, é.", "a .", "a!?,. b",
             "end <|endoftext|> more", "x<|startoftext|>y <|ENDOFTEXT|> Z", "<|endoftext|>" * 3,
             "the word  the\tword"]
    tokenizer = packing.WordTokenizer(tokenizer_path(name))
    assert tokenizer.by_words == (name == "word_bpe_49k.json")
    want = [coder.encode(t or "", add_special_tokens=False).ids for t in texts]
    for some in (texts, texts[-4:-1]):
        got = tokenizer.ids(pa.array(some))
        assert [g.tolist() for g in got] == want[: len(some)] if some is texts else want[-4:-1]


def test_ids_are_not_shuffled(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = packing.pack(docs, tokenizer_path())._jdf.queryExecution().executedPlan()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        lines = plan.toString().split("\n")
        depth = [re.search(r"[A-Za-z*]", line).start() if line.strip() else 0 for line in lines]
        scans = [i for i, line in enumerate(lines) if re.search(r"FileScan parquet.*\bids#", line)]
        assert len(scans) == 1 and "Bucketed: true" in lines[scans[0]]
        at, above = depth[scans[0]], []
        for i in range(scans[0], -1, -1):
            if depth[i] < at:
                at = depth[i]
                above.append(lines[i])
        assert any("ShuffledHashJoin" in line for line in above)
        assert not any(re.search("Exchange|Sort ", line) for line in above)


def test_mixture_of_a_thousand_queues_with_targets():
    rng = random.Random(6)
    lengths = [rng.randint(1, 10**6) for _ in range(1000)]
    weights = [rng.randint(1, 50) for _ in lengths]
    mixture = packing.Mixture(lengths, weights)
    total = sum(lengths)
    assert mixture.total == total
    for q in rng.sample(range(1000), 20):
        sent = [mixture.sent(q, x)[0] for x in range(0, total + 1, total // 50)]
        assert sent == sorted(sent) and mixture.sent(q, total)[0] == lengths[q]
    x = total // 3
    counts = [mixture.sent(q, x) for q in range(1000)]
    assert sum(c for c, _ in counts) == x
    assert [b for _, b in counts] == [sum(c for c, _ in counts[:q]) for q in range(1000)]


# ---- 4, 5 -----------------------------------------------------------------------------


def test_line_templates(spark, odd, none):
    rows = []
    for i, c in enumerate("abcdefghijkl"):
        rows.append((i, f"{c * 3} {c * 4} stays {c}\nPosted by user{i} on day {i}\n"
                        f"Visited by people from {c * 4} and the old town"))
    got = {r["doc_id"]: r for r in lines.drop_recurring(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["text"] == rows[0][1] and got[0]["n_dropped"] == 0
    assert all(got[i]["n_dropped"] == 2 and got[i]["text"] == rows[i][1].split("\n")[0] for i in range(1, 12))
    assert all(r["n_dropped"] == 0 for r in lines.drop_recurring(odd).collect())
    result = lines.drop_recurring(odd)
    assert result.columns == [*odd.columns, "n_lines", "n_dropped"]
    assert rows_of(result.select("doc_id", "text")) == rows_of(odd.select("doc_id", "text"))
    assert lines.drop_recurring(none).count() == 0


def test_a_token_of_one_document_is_no_constant(spark):
    """Ten lines of one document share a name; the template leaves it out, though its ten lines of
    twelve documents have the same leaf."""
    names = "Ann Ben Cy Dee Eve Fay Gus Hal Ian Joy Kim".split()
    places = "north south east west up down left right here there".split()
    rows = [(0, "\n".join(f"alpha beta gamma Bob went {p}" for p in places))]
    rows += [(i + 1, f"alpha beta gamma {n} went {places[i % 10]}") for i, n in enumerate(names)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows],
                                 "doc_id long, text string, n_lines int, N_DROPPED int")
    kept = lines.keyed(docs.select("doc_id", "text"))
    found = lines.templates(lines.leaves(lines.raw_lines(kept)))
    assert {r["template"] for r in found.collect()} == {"~alpha beta gamma <*> went <*>"}
    got = {r["doc_id"]: r for r in lines.drop_recurring(docs).collect()}
    assert got[0]["n_dropped"] == 0 and got[0]["n_lines"] == 10
    assert all(got[i]["n_dropped"] == 1 and got[i]["text"] == "" for i in range(1, 12))


def test_fences_follow_the_corpus(spark):
    """The same text is an outlier among prose and none where such texts are common."""
    rng = random.Random(7)

    def prose():
        return " ".join("x" * rng.randint(1, 9) + str(rng.randint(0, 99)) for _ in range(60))

    def code():
        return " ".join(w + rng.choice(["", " #", " |", " &"]) for w in prose().split())

    rows = [(i, prose(), "en", "books") for i in range(80)]
    rows += [(100 + i, code(), "en", "manuals") for i in range(80)]
    rows += [(300, code(), "en", "books"), (301, prose() + " $ &", "en", "books"),
             (302, code(), "en", "manuals")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(quality.with_counts(docs)).collect()}
    assert not kept[300] and kept[301] and kept[302]
    assert all(kept[i] for i in [*range(80), *range(100, 180)])


def test_stuttered_words_lie_outside_the_fence(spark):
    rows = [(i, " ".join(f"word{(i * k) % 97}" for k in range(1, 40)), "en", "s") for i in range(60)]
    rows.append((60, " ".join(f"word{k}" for k in range(6) for _ in range(7)), "en", "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    judged = {r["doc_id"]: r for r in quality.judge(quality.with_counts(docs)).collect()}
    assert judged[60]["n_stutters"] == 36 and not judged[60]["base_failed"]
    assert not judged[60]["kept"] and judged[7]["kept"] and judged[7]["n_stutters"] == 0


def test_quality_rules_on_odd_rows(spark, odd, none):
    judged = quality.judge(quality.with_counts(odd)).collect()
    assert len(judged) == odd.count()
    by = {r["doc_id"]: r for r in judged}
    assert by[1]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[3]["n_words"] == 30_500 and by[3]["base_failed"]
    kept = quality.kept_documents(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 5").count() == 1
    assert quality.kept_documents(none).count() == 0


# ---- 6 --------------------------------------------------------------------------------


def test_chat_round_trip_of_conflicting_texts(spark):
    marks = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE=", "\\", "<", "[", "/", "a", "\n", "é"]
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool\n]", None]),
             rng.choice([None, "".join(rng.choices(marks, k=rng.randint(0, 12)))]))
            for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(1, 0, "user", "tie"), (2, 0, "user", "long </s> " * 20_000)]
    alone = [(None, None, "user", "x"), (None, 1, "assistant", "y"), (None, 1, "assistant", "y")]
    frame = spark.createDataFrame([(*r, "x") for r in rows + alone],
                                  "conv_id long, turn long, role string, text string, TURNS string")
    assert chat.format_conversations(frame.limit(0)).count() == 0
    done = chat.format_conversations(frame)
    loose = done.where("conv_id IS NULL")
    assert sorted(r["formatted"] for r in loose.collect()) == [
        "<s>[/INST]y</s>", "<s>[/INST]y</s>", "<s>[INST]x</s>"]
    done = done.where("conv_id IS NOT NULL")
    done = done.selectExpr("*", f"{chat.loss_text()} AS loss").collect()
    assert all(r["round_trip"] for r in done) and any(r["escaped"] for r in done)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in done:
        turns = [(x[2] or "", x[3] or "") for x in sorted(
            (x for x in rows if x[0] == r["conv_id"]), key=key)]
        assert [tuple(t) for t in r["read"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")


# ---- 7 --------------------------------------------------------------------------------


def test_url_rules_and_models(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1")]
    rows = [(0, None), (1, "no scheme"), (2, "HTTP://Example.ORG/en/1x?q#f"), (3, "a://b.org"),
            (4, "a://B.example.org/es/x"), (5, "a://notexample.org/es/")]
    rows += [(100 + i, f"http://good{i}.org/news/{i}") for i in range(300)]
    rows += [(1000 + i, f"http://example.org/es/spam-{i}") for i in range(300)]
    rows += [(9000, "http://x.net/news/7"), (9001, "http://x.net/es/spam-7")]
    got = {r["page_id"]: r for r in urls.judge(
        spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert len(got) == len(rows)
    assert (got[0]["host"], got[0]["path"], got[0]["rule"]) == ("", "", None)
    assert got[2]["host"] == "example.org" and got[2]["path"] == "/en/1x"
    assert (got[2]["rule"], got[2]["verdict"]) == ("example.org/en/1", "block")
    assert got[3]["path"] == "" and got[3]["rule"] is None
    assert got[4]["rule"] == "example.org/es/" and got[5]["rule"] == "org/"
    assert got[9000]["verdict"] == "allow" and got[9001]["verdict"] == "block"
    alone = urls.judge(spark.createDataFrame(rows[:2], "page_id long, url string"), rules)
    assert [r["verdict"] for r in alone.collect()] == ["allow", "allow"]
    long = "http://x.net/" + "news/7" * 20_000
    clash = spark.createDataFrame(
        [(*r, "c", 1) for r in rows + rows[-2:] + [(9002, long)]],
        "page_id long, url string, VERDICT string, score int")
    again = [r for r in urls.judge(clash, rules).collect() if r["page_id"] >= 9000]
    assert sorted((r["page_id"], r["verdict"]) for r in again) == [
        (9000, "allow"), (9000, "allow"), (9001, "block"), (9001, "block"), (9002, "allow")]
    assert len({r["score"] for r in again if r["page_id"] == 9000}) == 1
    assert urls.judge(clash.limit(0), rules).count() == 0


def test_url_scores_equal_exact_models(spark):
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"http://h.{'org' if i % 2 else 'com'}/" + "".join(rng.choices(letters, k=24)))
            for i in range(4000)]
    rows += [(9000, "http://x.net/" + rows[0][1][-9:]), (9001, None), (9002, "http://x.net/0/é")]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    rules = [("allow", "org/"), ("block", "com/")]
    got = {r["page_id"]: r["score"] for r in urls.judge(pages, rules).collect()}
    held = {r["page_id"] for r in pages.where("pmod(xxhash64(url), 5) = 0").collect()}

    def coded(url):
        rest = (url or "").partition("://")[2].lower().encode()
        return bytes(48 if 48 <= c <= 57 else c for c in rest)

    seen, both = ({}, {}), ({}, {})
    for i, url in rows[:4000]:
        if i not in held:
            body = bytes(5) + coded(url)
            for at in range(5, len(body)):
                for k in range(6):
                    c = (k, body[at - k : at])
                    seen[i % 2][c] = seen[i % 2].get(c, 0) + 1
                    c = (*c, body[at])
                    both[i % 2][c] = both[i % 2].get(c, 0) + 1
    for i, url in rows[:200] + rows[4000:]:
        body, gain = bytes(5) + coded(url), 0.0
        for at in range(5, len(body)):
            chance = [1 / 256, 1 / 256]
            for k in range(6):
                c = (k, body[at - k : at])
                for x in (0, 1):
                    chance[x] = (both[x].get((*c, body[at]), 0) + 4 * chance[x]) / (seen[x].get(c, 0) + 4)
            gain += np.log(chance[1]) - np.log(chance[0])
        assert abs(got[i] - gain / max(1, len(body) - 5)) < 1e-9


# ---- 8 --------------------------------------------------------------------------------


def units_of(text):
    coded = (text or "").encode()
    if not coded:
        return []
    ((start, end, words, body),) = substrings.units(
        np.frombuffer(coded, np.uint8), np.array([0, len(coded)]))
    at = lambda k: len(coded[:k].decode())
    return [(at(a), at(b), b" ".join(body[a:b].split()), n) for a, b, n in zip(start, end, words)]


def runs(flags, units):
    out, first = [], None
    for k in range(len(units) + 1):
        if k < len(units) and flags[k]:
            first = k if first is None else first
        elif first is not None:
            if sum(u[3] for u in units[first:k]) >= substrings.MIN_WORDS:
                out.append((first, k))
            first = None
    return out


def test_substring_dedup_equals_brute_force(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rng = random.Random(9)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(55))
    extra = [(10_000 + i, f"start {i} of it {passage} and then {i} more") for i in range(3)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    texts = {r["doc_id"]: units_of(r["text"]) for r in docs.collect()}
    n = {}
    for units in texts.values():
        for u in units:
            n[u[2]] = n.get(u[2], 0) + 1
    seen, want = set(), {}
    for i in sorted(texts):
        units = texts[i]
        inside = {k for a, b in runs([n[u[2]] > 1 for u in units], units) for k in range(a, b)}
        later = [k in inside and units[k][2] in seen or (
            k in inside and units[k][2] in {units[j][2] for j in inside if j < k})
            for k in range(len(units))]
        seen |= {units[k][2] for k in inside}
        want[i] = [(units[a][0], units[b - 1][1]) for a, b in runs(later, units)]
    got = {r["doc_id"]: r for r in substrings.remove_repeats(docs).collect()}
    assert {i: [(s["start"], s["end"]) for s in r["removed"]] for i, r in got.items()} == want
    assert all(passage.split()[20] not in got[10_000 + i]["text"] for i in (1, 2))
    assert passage in got[10_000]["text"]
    result = substrings.remove_repeats(odd)
    assert result.columns == [*odd.columns, "n_units", "n_removed", "removed"]
    by = {r["doc_id"]: r for r in result.collect()}
    assert by[1]["text"] is None and by[1]["n_units"] == 0 and by[3]["n_removed"] > 0
    assert len(by[4]["text"]) < 100
    assert substrings.remove_repeats(none).count() == 0


def test_repeats_in_scripts_without_spaces(spark):
    rng = random.Random(3)

    def prose(first, n, stop):
        return "".join(chr(first + rng.randrange(60)) + (stop if i % 25 == 24 else "") for i in range(n))

    shared = {"zh": prose(0x4E00, 200, "\u3002"), "th": prose(0x0E01, 200, ""),
              "ja": prose(0x3041, 200, "\uff01")}
    rows = [(10 * k + i, f"{prose(0x5E00, 30, '')}{s}{prose(0x6E00, 30, '')} abc{i}")
            for k, s in enumerate(shared.values()) for i in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.remove_repeats(docs).collect()}
    for k, s in enumerate(shared.values()):
        first, later = dict(rows)[10 * k], dict(rows)[10 * k + 1]
        assert got[10 * k]["text"] == first
        assert s[100:110] not in got[10 * k + 1]["text"]
        (gone,) = got[10 * k + 1]["removed"]
        assert 150 <= gone["end"] - gone["start"] <= 200
        assert later[gone["start"] : gone["end"]] in s
    text = "a\u4e2db\u6587\u3002\u300dcd e"
    words = [text[a:b] for a, b in _word_places(text)]
    assert words == ["a", "\u4e2d", "b", "\u6587\u3002\u300d", "cd", "e"]


def _word_places(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    words = substrings.words_of(
        raw, np.array([0, len(raw)]), substrings._lowered(), substrings._breaks(raw))
    at = lambda k: len(raw[:k].tobytes().decode())
    return [(at(a), at(b)) for a, b in zip(words.start, words.stop)]


def test_columns_named_as_results_of_substring_dedup(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "x", 2), (2, None, 6, "y", 3)],
                                 "doc_id long, text string, N_REMOVED int, removed string, later int")
    got = substrings.remove_repeats(docs).orderBy("doc_id").collect()
    assert [(r["n_removed"], r["removed"]) for r in got] == [(0, []), (0, [])]
    assert got[0]["text"] == "a b c" and got[1]["text"] is None


def test_recall_of_unmarked_passages(spark):
    """Passages without sentence marks, each in two documents: from 50 words on every one is found,
    and at most 30 words of it stay at its ends."""
    rng = random.Random(21)

    def words(n):
        return " ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(10**6)}"
                        for _ in range(n))

    rows, of = [], {}
    for n in (50, 51, 60, 80, 150):
        for _ in range(400):
            passage = words(n)
            for _ in range(2):
                of[len(rows)] = (n, passage)
                rows.append((len(rows), f"{words(12)} {passage} {words(12)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r for r in substrings.remove_repeats(docs).collect()}
    assert not any(got[i]["removed"] for i in range(0, len(rows), 2))
    for i in range(1, len(rows), 2):
        n, passage = of[i]
        (gone,) = got[i]["removed"]
        span = rows[i][1][gone["start"] : gone["end"]].strip()
        assert f" {span} " in f" {passage} "
        assert n - 2 * substrings.WINDOW <= len(span.split()) <= n


def test_cuts_are_the_least_of_their_neighbours():
    """Cut places against a loop, for texts that share an array with others and texts that don't."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(n))
             for n in (0, 1, 14, 15, 16, 17, 40, 200, 3, 90)]

    def arrays(some):
        coded = [t.encode() for t in some]
        raw = np.frombuffer(b"".join(coded), np.uint8)
        return raw, np.r_[0, np.cumsum([len(c) for c in coded])]

    together = [
        [body[a:b].split() for a, b in zip(start, end)]
        for start, end, _, body in substrings.units(*arrays(texts))
    ]
    for text, got in zip(texts, together):
        raw, offsets = arrays([text])
        words = substrings.words_of(raw, offsets, substrings._lowered())
        said, want = text.encode().split(), [[]]
        with np.errstate(over="ignore"):
            pair = (words.hash[1:] * np.uint64(0x9E3779B97F4A7C15) + words.hash[:-1]) | np.uint64(1)
        value, w = pair.tolist(), substrings.WINDOW
        chosen = {
            k for at in range(len(value) - w + 1) for k in range(at, at + w)
            if value[k] == min(value[at : at + w])
        }
        for k, word in enumerate(said):
            want[-1].append(word)
            if k and (k - 1 in chosen or said[k - 1] == word):
                want.append([])
        assert got == [u for u in want if u]


# ---- 9 --------------------------------------------------------------------------------


def brute_profile(text):
    """Bundled n-gram vectors, one n-gram at a time."""
    low = "".join(chr(langid.Letters._lower(ord(c))) for c in f"\0{text}\0")
    out = np.zeros(langid.DIMENSIONS, np.int64)

    def letter(c):
        draw = np.random.Generator(np.random.PCG64([langid.SEED, ord(c)]))
        return 2 * draw.integers(0, 2, langid.DIMENSIONS) - 1

    for a, b, c in zip(low, low[1:], low[2:]):
        if b != "\0":
            out += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
    return out


def test_language_equals_brute_force(spark):
    rng = random.Random(10)
    kinds = {"aa": "abcÉ ", "bb": "xyzß' ", "cc": "日本語ab "}
    rows = [(i, "".join(rng.choices(kinds[k], k=rng.randint(1, 40))), k, "old", 7)
            for i, k in enumerate(rng.choices(list(kinds), k=60))] + [(99, "123 -", "aa", "old", 7)] * 2
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, lang_pred string, SCORE int").repartition(4)
    learned = langid.learn(docs)
    want = {k: sum(brute_profile(t) for _, t, lang, _, _ in rows if lang == k) for k in kinds}
    assert set(learned) == set(want) and all((learned[k] == want[k]).all() for k in want)
    got = langid.predict(docs, learned).collect()
    assert len(got) == len(rows)
    for r in got:
        v = brute_profile(r["text"])
        if not v.any():
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        likeness = {k: v @ w / np.linalg.norm(v) / np.linalg.norm(w) for k, w in want.items()}
        assert abs(r["score"] - max(0, max(likeness.values()))) < 1e-9
        assert likeness[r["lang_pred"]] >= max(likeness.values()) - 1e-9
    assert langid.predict(docs.limit(0), learned).count() == 0


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    docs = spark.range(4).selectExpr("CAST(id AS STRING) AS lang", "'x' AS text")
    with pytest.raises(ValueError, match="more than 3"):
        langid.learn(docs)


def test_language_of_held_out_documents(spark, odd, none):
    got = QUERIES["op9_language_id"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    learned = langid.learn(odd)
    said = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd, learned).collect()}
    assert said[1] == said[2] == said[6] == "und" and said[5] == "fr" and said[3] == "en"
    assert langid.learn(none) == {}
    assert langid.predict(odd, {}).where("lang_pred <> 'und'").count() == 0


# ---- 10 -------------------------------------------------------------------------------


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+",
                       re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=3):
    """Position of the first member of each one's component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_simhash_equals_brute_force(spark, odd):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(),
                  key=lambda r: r["doc_id"])
    prints = [brute_print(r["text"]) for r in docs]
    want = {docs[i]["doc_id"]: (f"{prints[i]:016x}", docs[k]["doc_id"])
            for i, k in enumerate(brute_components(prints))}
    got = QUERIES["op10_simhash"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == want
    rows = simhash.near_duplicates(
        simhash.with_fingerprint(odd, keep_text=False).select("doc_id", "fingerprint")).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r["component_id"] for r in rows}
    assert by[1] == by[2] == by[6] == 1 and by[4] == by[3] == 3 and by[None] is None
    kept = simhash.one_per_component(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "5", "None"]


def test_simhash_of_no_rows_and_clashing_columns(spark, none):
    schema = "doc_id long, text string, FINGERPRINT string, component_id int, Row_Number int, x int"
    rows = [(1, "a b c d", "f", 7, 8, 9), (2, "A b c d", "f", 7, 8, 9), (3, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    prints = simhash.with_fingerprint(docs)
    assert [c for c in prints.columns if c.lower() == "fingerprint"] == ["fingerprint"]
    found = simhash.near_duplicates(prints)
    assert {(r["doc_id"], r["component_id"], r["x"]) for r in found.collect()} == {
        (1, 1, 9), (2, 1, 9), (3, 3, None)}
    kept = simhash.one_per_component(docs)
    assert kept.columns == ["doc_id", "text", "component_id", "x"]
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a b c d", 7, 9), (3, None, None, None)]
    for empty in (none, docs.limit(0)):
        assert simhash.near_duplicates(simhash.with_fingerprint(empty)).count() == 0
        assert simhash.one_per_component(empty).count() == 0


def test_chains_and_large_cells_lose_no_link(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(400):  # one dense ball and a chain
        prints.add(base ^ sum(1 << rng.randrange(64) for _ in range(2)))
        base2 = max(prints)
        prints.add((base2 ^ (7 << rng.randrange(61))) & (1 << 64) - 1)
        prints.add(rng.getrandbits(64))
    prints = sorted(p & (1 << 64) - 1 for p in prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = brute_components(prints)
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for limit in (50_000, 20):
        links = simhash.edges(simhash.cells(df, 3, limit=limit), 3)
        rooted = {r["node"]: r["root"] for r in simhash.components(links).collect()}
        got = [rooted.get(p, p) for p in signed]
        groups = lambda labels: {
            frozenset(i for i, x in enumerate(labels) if x == y) for y in labels}
        assert groups(got) == groups(want)


def test_a_dense_ball_and_wide_links(spark):
    """Two balls that only another vantage point tells apart, one that none does, and links of more
    bits than a band is wide."""
    rng = random.Random(3)
    a = rng.getrandbits(64)
    prints = {a, a ^ (1 << 64) - 1}
    for i in range(64):
        prints |= {a ^ (1 << i), a ^ (1 << i) ^ (1 << (i + 7) % 64)}
        prints |= {a ^ 0xFFF ^ (1 << i), rng.getrandbits(64)}
    prints = sorted(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for bits in (1, 3, 10):
        want = brute_components(prints, bits)
        links = simhash.edges(simhash.cells(df, bits, limit=20), bits)
        rooted = {r["node"]: r["root"] for r in simhash.components(links).collect()}
        got = [rooted.get(p, p) for p in signed]
        groups = lambda labels: {
            frozenset(i for i, x in enumerate(labels) if x == y) for y in labels}
        assert groups(got) == groups(want)
    with pytest.raises(ValueError, match="max_bits"):
        simhash.cells(df, 40)
    clash = spark.createDataFrame([(1, 5, "x", "y")],
                                  "doc_id long, fingerprint long, COMPONENT string, component_id string")
    assert simhash.near_duplicates(clash).first()["component_id"] == 1
    empty = simhash.near_duplicates(clash.limit(0))
    assert empty.count() == 0 and "component_id" in empty.columns


# ---- pipeline -------------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark, duck):
    rows = duck.execute(f"""WITH {quality_sql('documents')},
      good AS (SELECT doc_id, text, lang, source, n_chars FROM judged WHERE kept),
      {line_sql('good')}
      SELECT doc_id, text FROM l_kept WHERE n_dropped = 0 OR n_dropped < n_lines
      ORDER BY doc_id""").fetchall()
    first = brute_components([brute_print(t) for _, t in rows])
    rows = [r for i, r in enumerate(rows) if first[i] == i]
    bench = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    hits = [brute_hits(t, bench) for _, t in rows]
    rows = [r for r, (n, h, _) in zip(rows, hits) if not (h and 20 * h >= n)]
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in got} == {r[0] for r in rows}
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    ids = {i: coder.encode(t, add_special_tokens=False).ids + [1] for i, t in rows}
    for r in got:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert zlib.crc32(part) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])


def test_stages_keep_the_columns_of_documents(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SMALL).columns == docs.columns


def test_stages_on_odd_rows(spark, odd, none):
    """Which rows each stage keeps of NULLs, empty and long texts and repeated rows."""
    stages = dict(corpus_pipeline.STAGES)

    def ids(df):
        return sorted(str(r["doc_id"]) for r in df.collect())

    everything = ids(odd)
    assert ids(stages["quality_rules"](spark, odd, SMALL)) == ["5"]
    assert ids(stages["line_dedup"](spark, odd, SMALL)) == everything
    assert ids(stages["simhash_dedup"](spark, odd, SMALL)) == ["1", "3", "5", "None"]
    assert ids(stages["decontamination"](spark, odd, SMALL)) == everything
    pieces = stages["packing"](spark, odd, SMALL).collect()
    assert {str(r["doc_id"]) for r in pieces} == set(everything)
    assert sum(r["length"] for r in pieces if r["doc_id"] in (1, 2, 6)) == 3
    assert stages["packing"](spark, none, SMALL).count() == 0


def test_digests_are_lowercase_hex(spark):
    row = QUERIES["op1_decontamination"](spark, SMALL).where("n_items = 0").first()
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest()
