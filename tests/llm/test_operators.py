"""Single operators and helpers on small inputs."""

import hashlib
import random
from collections import Counter, defaultdict

import brute
import fixtures
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from saldoflow.llm import exact_dedup, html_extract, language_id, license_scan, line_rules, mixing, ngram_join, packing, quality, queries, warc
from saldoflow.llm import textarrays as ta
from saldoflow.llm.components import components
from saldoflow.llm.queries import MIX_SEED, MIX_WEIGHTS, TOKENIZER
from saldoflow.sources.storage import new_folder

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# --- helpers -------------------------------------------------------------------------------

def test_blocks_keep_whole_texts():
    texts = [None, "", "aé", "b" * 50, "c", None, "d e"]
    for limit in (1, 8, 1000):
        column = pa.array(["skipped", *texts]).slice(1)
        got = [b.data[i:j].tobytes().decode() for b in ta.blocks(column, limit) for i, j in zip(b.offsets, b.offsets[1:], strict=False)]
        assert got == [t or "" for t in texts]
    assert list(ta.blocks(pa.array([], pa.string()))) == []


def test_shingle_sets_match_plain_sets():
    texts = [t or "" for t in fixtures.TEXTS]
    for limit in (64, 1 << 20):
        counts, digests = [], []
        for block in ta.blocks(pa.array(texts), limit):
            tokens, n = ngram_join.shingle_sets(block, 5)
            counts += n.tolist()
            digests += list(zip(*ngram_join.set_digests(tokens, n), strict=True))
        sets = [brute.shingles(t) for t in texts]
        assert counts == [len(s) for s in sets]
        assert len(set(digests)) == len(set(sets))


def test_hashes_match_plain_ones():
    data = np.frombuffer(b"word w\xc3\xb6rd word", np.uint8)
    starts, ends = ta.runs(1 - ta.SPACE[data], np.array([0, len(data)]))
    hashes = ta.hash_runs(data, starts, ends)
    assert hashes.tolist() == [brute.token_hash(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert ta.hash_sequences([hashes[:1], hashes[1:2]]).tolist() == [brute.sequence_hash(hashes[:2].tolist())]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(99), rnd.randrange(99)) for _ in range(60)]
    edges += [(500 + i, 499) for i in range(50)]
    rnd.shuffle(edges)
    nodes = {x for a, b in edges for x in (a, b) if a != b}
    expected = brute.roots(nodes, [e for e in edges if e[0] != e[1]])
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted((r.node, r.root) for r in got) == sorted(expected.items())


def test_no_shared_token_is_missed():
    """Counts of step 1 of the n-gram join, whatever rows a task has; copies may only add."""
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(60))) for _ in range(200)] + ["a b c d e f g"] * 5 + [None]
    texts += [f"{t} x" for t in texts[:40]]
    targets, groups, parts, got = 8, defaultdict(list), defaultdict(list), {}

    def deal(table, column, into):
        for i in range(table.num_rows):
            into[table.column(column)[i].as_py()].append(table.slice(i, 1))

    for rows in (texts[:90], texts[90:91], texts[91:]):
        batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["text"])
        for blob in ngram_join._token_blobs(5, targets)(iter([batch])):
            deal(pa.Table.from_batches([blob]), "target", groups)
    for tables in groups.values():
        deal(ngram_join._shared_counts(targets)(pa.concat_tables(tables)), "part", parts)
    for tables in parts.values():
        summed = ngram_join._summed(pa.concat_tables(tables))
        got |= dict(zip(summed.column("d1").to_pylist(), summed.column("shared").to_pylist(), strict=True))
    block = next(ta.blocks(pa.array(texts, pa.string())))
    digests = ngram_join.set_digests(*ngram_join.shingle_sets(block, 5))[0].view(np.int64).tolist()
    sets = {d: brute.shingles(t) for d, t in zip(digests, texts, strict=True)}
    holders = Counter(x for s in sets.values() for x in s)
    assert all(got.get(d, 0) >= sum(holders[x] > 1 for x in s) for d, s in sets.items())


# --- operators -----------------------------------------------------------------------------

def test_index_takes_batches(spark):
    name = f"digests_{random.randrange(10**12)}"
    index = exact_dedup.DigestIndex(spark, name, 4)
    rows = lambda *r: spark.createDataFrame(list(r), "doc_id bigint, text string")
    first = exact_dedup.mark(rows((5, "a  b"), (3, "a b"), (4, "c"), (4, "c")), index).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in first) == [
        (3, 3, 2, True), (4, 4, 2, False), (4, 4, 2, True), (5, 3, 2, False)]
    assert first[0].text_sha256 in {hashlib.sha256(t).hexdigest() for t in (b"a b", b"c")}
    again = exact_dedup.DigestIndex(spark, name, 4)
    second = exact_dedup.mark(rows((1, "a\tb"), (9, "d"), (None, "d")), again).collect()
    assert sorted(((r.doc_id or 0), r.keep_id, r.kept) for r in second) == [(0, 9, False), (1, 3, False), (9, 9, True)]
    kept = exact_dedup.deduplicate(rows((7, "d"), (8, "e"), (8, "e"), (None, None), (None, "")), again).collect()
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept) == [(0, ""), (8, "e")]
    assert again.read().count() == 5
    plan = again.read().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the table is bucketed by digest
    again.drop()


def test_a_batch_that_is_sent_again_gets_the_same_answers(spark):
    index = exact_dedup.DigestIndex(spark, f"digests_{random.randrange(10**12)}", 4)
    rows = spark.createDataFrame([(5, "a  b"), (3, "a b"), (4, "c"), (4, "c"), (None, "d"), (8, "e"), (9, "e")], "doc_id bigint, text string")
    marked = lambda r: sorted((tuple(x) for x in exact_dedup.mark(r, index, batches=2).collect()), key=repr)
    first = marked(rows)
    assert marked(rows) == first and marked(rows) == first
    assert exact_dedup.deduplicate(rows, index).count() == 4 and index.read().count() == 4
    later = spark.createDataFrame([(1, "c"), (2, "f"), (9, "e")], "doc_id bigint, text string")
    assert [r.doc_id for r in exact_dedup.deduplicate(later, index).collect()] == [2]
    assert marked(rows) == first
    index.drop()


def test_text_ids(spark):
    index = exact_dedup.DigestIndex(spark, f"digests_{random.randrange(10**12)}", 4, "string")
    rows = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "y"), ("c", "y")], "doc_id string, text string")
    got = sorted((r.doc_id or "", r.keep_id, r.kept) for r in exact_dedup.mark(rows, index, batches=3).collect())
    assert got == [("", "c", False), ("a", "a", True), ("b", "a", False), ("c", "c", True)]
    index.drop()
    assert exact_dedup.buckets_for(10) == 64 and exact_dedup.buckets_for(10**9) == 250


def test_the_query_and_the_stage_meet_a_filled_index(spark, tmp_path, monkeypatch):
    folder, held, append = fixtures.write(tmp_path, "odd"), [], exact_dedup.DigestIndex.append

    def noted(index, digests):
        held.append(index.read().count())
        return append(index, digests)

    monkeypatch.setattr(exact_dedup.DigestIndex, "append", noted)
    docs = queries.documents(spark, folder)
    texts = {exact_dedup_key(r["text"]) for r in docs.collect()}
    for run in (lambda: queries.op6_exact_dedup(spark, folder).filter("kept"),
                lambda: corpus_pipeline.exact_deduplication(spark, docs, folder)):
        held.clear()
        assert run().count() == len(texts)
        assert len(held) > 1 and held[0] == 0 < held[1]


def test_archive_is_rebuilt_to_the_byte(spark):
    folder = new_folder(spark, "warc")
    html = fixtures.PAGE.format("é" * 600)
    pages = spark.createDataFrame([(1, "http://a/\r\nx", html), (2, None, html), (3, "http://b", None)], "page_id bigint, url string, html string")
    warc.write_archive(pages, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 2
    records = {r.page_id: r for r in warc.record_bytes(warc.read_archive(spark, folder)).collect()}
    body = html.encode()
    assert bytes(records[2].record).endswith(body + b"\r\n\r\n") and b"WARC-Target-URI" not in bytes(records[2].record)
    assert records[1].record_type == "revisit" and records[1].refers_to == 2 and bytes(records[1].payload) == body
    assert records[1].url == "http://a/%0D%0Ax" and body not in bytes(records[1].record)
    for r in records.values():
        head, rest = bytes(r.record).split(b"\r\n\r\n", 1)
        length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert len(rest) == length + 4 and rest.endswith(b"\r\n\r\n")
        assert r.payload_digest == hashlib.sha1(bytes(r.payload)).hexdigest()


def test_a_wrong_payload_is_an_error(spark):
    folder = new_folder(spark, "warc")
    warc.write_archive(spark.createDataFrame([(1, "u", "x")], "page_id bigint, url string, html string"), folder)
    wrong = spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit(b"y")).collect()
    spark.createDataFrame(wrong, "digest binary, payload binary").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="doesn't match"):
        warc.read_archive(spark, folder).collect()


def test_mix_meets_the_weights(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"),
        F.when(F.col("id") < 5000, "big").when(F.col("id") < 5990, "mid").when(F.col("id") < 5998, None).otherwise("void").alias("source"),
    ).withColumn("text", F.when(F.col("source") == "void", "").otherwise(F.col("text")))
    weights = {"big": 1.0, "mid": 2.0}
    mixed = mixing.mix(docs, weights, default_weight=0.5, seed=3)
    size = {r.source: r.n for r in mixed.groupBy("doc.source").agg(F.sum(F.length("doc.text")).alias("n")).collect()}
    total = sum(size.values())
    assert abs(size["mid"] / total - 2 / 3.5) < 0.04 and abs(size["big"] / total - 1 / 3.5) < 0.04
    assert abs(size[None] / total - 0.5 / 3.5) < 0.04  # a rate far above a piece
    rates = {r.source: r.rate for r in mixing.source_rates(docs, weights, 0.5).collect()}
    assert rates["void"] == 1.0 and rates[None] > mixing.PIECE
    keys = mixed.select(F.spark_partition_id().alias("p"), "shuffle_key").collect()
    assert all(a.shuffle_key <= b.shuffle_key for a, b in zip(keys, keys[1:], strict=False) if a.p == b.p)


def test_method_labels_need_their_key_phrases(spark):
    texts = fixtures.TEXTS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {texts[r.doc_id]: r for r in license_scan.scan(docs).collect()}
    granted = next(t for t in texts if t and "free of charge" in t)
    assert got[granted].labels == "mit" and got[granted].base_labels == "" and got[granted].score == 1.0
    assert got[granted.replace("charge", "cost")].labels == ""
    gpl = next(t for t in texts if t and "General Public" in t)
    assert got[gpl].labels == "gpl-3" and [m.start for m in got[gpl].matches] == [0]


@pytest.mark.parametrize("seed", range(4))
def test_first_fit_decreasing(seed):
    rnd = random.Random(seed)
    lengths = [rnd.randint(1, 99) for _ in range(rnd.choice([0, 1, 2, 33, 300]))]
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == brute.first_fit_decreasing(lengths, 100)


def test_pieces_encode_like_whole_texts():
    encoder = packing.PieceEncoder(TOKENIZER)
    texts = [t or "" for t in fixtures.TEXTS] + [
        "don't we're I'M 'S x's '' ' 's--'s a.'s", "«a», »b«. a»,b ≠ á. éx,", "İSTANBUL ΑΣ. ΑΣ x.Σ", "a\tb\r\nc\x1cd\x85e f",
        "a <|endoftext|> b", "A <|EndOfText|>b", "x<|startoftext|>Y é<|ENDOFTEXT|>", "<|endoftext", "１２ ½.5 x² a1b2", "ＦＵＬＬ w.", "ŉ ǅ.ǆ, ﬁ.x", "̀a .̀ ǹ", "a\x00b\x7f.c"]
    own = Tokenizer.from_file(TOKENIZER)
    whole = [np.array(e.ids, "<u4").tobytes() for e in own.encode_batch(texts, add_special_tokens=False)]
    assert encoder.ids(texts) == whole and encoder.ids(texts[::-1]) == whole[::-1]


def test_every_plain_character_encodes_as_in_the_whole_text():
    """The dotted capital I becomes two characters, the second of which joins a sign after it."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    chars = [chr(c) for c in [*range(0x20, 0x7F), *range(0xC0, 0x250)]]
    texts = ["GAZETES\u0130."] + [x for c in chars for x in (f"a{c}.", f".{c}a", f"{c}{c}!1", f"1{c}.x y")]
    whole = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert packing.PieceEncoder(TOKENIZER).ids(texts) == whole


@pytest.mark.parametrize("k", [0, 1, 7, 999, 1000, 1001])
def test_kth_largest(spark, k):
    keys = [float((i * 7919) % 1000) / 7 for i in range(990)] + [3.0] * 10
    frame = spark.createDataFrame([(x,) for x in keys], "key double")
    expected = np.inf if k == 0 else min(keys) if k > 1000 else sorted(keys, reverse=True)[k - 1]
    assert quality.kth_largest(frame, k, gathered=20) == expected


def test_best_cut():
    weights, good = np.array([-5.0, -4.0, 1.0, 1.0, 2.0]), np.array([False, False, True, False, True])
    assert quality.best_cut(weights, good) == -1.5
    assert quality.best_cut(weights, np.ones(5, bool)) == -np.inf
    assert quality.best_cut(np.zeros(0), np.zeros(0, bool)) == -np.inf


# --- pages ---------------------------------------------------------------------------------

PAGES = [
    ('<body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><main><article><header><h1>Title</h1></header>'
     '<p>One &amp; two<br>three</p><div class="ad-banner">Buy</div><ul><li>a<li>b</ul><aside>side</aside><section id="comments"><p>nice</p>'
     '</section><div class="share">x</div></article></main><footer>f</footer>', ["Title", "One & two three", "a", "b"]),
    ('<div id="content"><h2>H</h2><p>text one<p>text two<div>in div</div></div><div class="sidebar">s</div>', ["H", "text one", "text two", "in div"]),
    ("<body><p>plain page</p><table><tr><td>x<td>y</table><form><p>in form</p><input></form><p>after", ["plain page", "x", "y", "after"]),
    ('<article><p>a<b>bold<p>c</b>d</p>tail<script>var x="</article>"</script><style>p{}</style> more</article>x', ["abold", "cd", "tail more"]),
    ('<article>outer <article class="comment"><p>cm</p></article> rest</article>', ["outer", "rest"]),
    ('<ARTICLE CLASS="post no-sidebar has-comments"><P>up</P></ARTICLE>', ["up"]),
    ('<article><p>one</p><div class="notice">N</div><noscript>n</noscript><button>B</button><select><option>o</select><textarea>t</textarea>'
     '<p hidden>h</p><p>two</p></article>', ["one", "two"]),
    ("<p>no end <!-- comment <p>hidden", ["no end"]), ("", []), ("<", ["<"]), ("<div class='", []),
]


@pytest.mark.parametrize("html,blocks", PAGES)
def test_main_text(html, blocks):
    assert html_extract.main_text(html, set()) == "\n\n".join(blocks)


KEPT = [
    ("<main><h1>Title</h1><p>text</p><article class=card>teaser</article></main>", ["Title", "text", "teaser"]),
    ("<main><h1>Title</h1><article><p>text</p></article></main><div class=content>other</div>", ["Title", "text"]),
    ("<article><h2 id='search-results'>Search results</h2><section id='related-work'><p>work</p></section><h2 id='social-sharing'>Sharing</h2>"
     "<section class='related-work'><p>more</p></section></article>", ["Search results", "work", "Sharing", "more"]),
    ("<article><p>where <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds</p></article>", ["where x=1 holds"]),
    ("<article><p>a</p><div class='related-posts'>r</div><div class='adBox'>b</div><div class='ad-300x250'>c</div><div class='comment-list'>d"
     "</div><section id='comments'>e</section><nav>f</nav><div role='search'>g</div></article>", ["a"]),
]


@pytest.mark.parametrize("html,blocks", KEPT)
def test_text_of_articles_and_main_elements_stays(html, blocks):
    assert html_extract.main_text(html, set()) == "\n\n".join(blocks)


def test_statistics_decide_on_main_text_beside_an_article(spark):
    html = "<main><h1>Title {0}</h1><div class='intro'>Shown on every page</div><p class='lead'>lead {0}</p><article>text {0}</article><h4>Read on</h4></main>"
    pages = spark.createDataFrame([(i, "http://m.example", html.format(i)) for i in range(8)], "page_id bigint, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in html_extract.extract(pages).collect()}
    assert got == {i: [f"Title {i}", f"lead {i}", f"text {i}"] for i in range(8)}


def test_branches_that_show_the_same_everywhere_are_removed(spark):
    def page(i):
        return (f'<body><div class="box"><div class="top-{i}">Welcome to our site</div><p>unique {i}</p><section><span>Shown on every page</span>'
                f'</section><section class="story"><p>story {i} of many</p><p>the same passage</p></section></div></body>')

    rows = [(i, f"https://A.example/{i}", page(i)) for i in range(12)] + [(90 + i, "https://b.example", page(0)) for i in range(9)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3].split("\n\n") == ["story 3 of many", "the same passage"]
    plain = [(i, "http://c.example", f'<div class="box"><div>Welcome</div><div class="x">text {i}</div></div>') for i in range(12)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(plain, "page_id bigint, url string, html string")).collect()}
    assert got[3] == "text 3"
    tree = html_extract.site_style_tree(spark.createDataFrame(plain, "page_id bigint, url string, html string"))
    importance = {r.path.rsplit("/", 1)[-1]: r.importance for r in tree.collect()}
    assert importance["div"] < 0.1 < 0.9 <= importance["div.x"]


def test_a_host_of_any_size_loses_its_repeated_branches(spark):
    """A notice on 4 of 200 pages, and one on all 41 distinct pages of a host with 1,000 rows."""
    def page(i, notice):
        return f'<div class="box">{notice}<div class="x">text {i}</div></div>'

    note = '<div class="note">Shown on every page</div>'
    rows = [(i, "http://large.example", page(i, note if i < 4 else "")) for i in range(200)]
    rows += [(1000 + i, "http://copies.example", page(max(0, i - 959), note)) for i in range(1000)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"text {i}" for i in range(200)} | {1000 + i: f"text {max(0, i - 959)}" for i in range(1000)}


# --- pipeline ------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    """Each stage against a brute-force version of it, on what the stage before it kept."""
    folder = fixtures.write(tmp_path, "odd")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources", "packing"]
    docs, left = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, folder)
        path = str(tmp_path / name.replace(" ", "-"))
        found.write.parquet(path)
        before = [r.asDict() for r in docs.collect()]
        docs = spark.read.parquet(path)
        after = [r.asDict() for r in docs.collect()]
        left.append(len(after))
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        key = lambda r: tuple(map(repr, r.values()))
        if name == "quality classifier":
            judged = quality.judge(spark.createDataFrame(before, DOCS), quality.fit(
                spark.createDataFrame(before, DOCS), spark.read.parquet(f"{folder}/labels.parquet")))
            assert sorted(after, key=key) == sorted((r.doc.asDict() for r in judged.filter("kept").collect()), key=key)
            assert 0 < len(after) < len(before)
        if name == "exact dedup":
            best = {}
            for r in sorted(before, key=lambda r: r["doc_id"]):
                best.setdefault(" ".join((r["text"] or "").split(" ")), r)
            normal = {exact_dedup_key(r["text"]): r for r in reversed(sorted(before, key=lambda r: r["doc_id"]))}
            assert sorted(after, key=key) == sorted(normal.values(), key=key)
        if name == "n-gram Jaccard join":
            expected = brute.near_duplicates([(r["doc_id"], r["text"]) for r in before])
            assert sorted(after, key=key) == sorted((r for r in before if expected[r["doc_id"]][1] == r["doc_id"]), key=key)
        if name == "mixing sources":
            counts = {r.doc.doc_id: r.n_copies for r in mixing.mix(spark.createDataFrame(before, DOCS), MIX_WEIGHTS, seed=MIX_SEED).collect()}
            assert sorted(after, key=key) == sorted((r for r in before for _ in range(counts.get(r["doc_id"], 0))), key=key)
        if name == "packing":
            lengths = {}
            for r in after:
                lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
            encoder = packing.PieceEncoder(TOKENIZER)
            texts = {}
            for r in before:
                texts.setdefault(r["doc_id"], []).append(len(encoder.ids([r["text"] or ""])[0]) // 4 + 1)
            assert lengths == {i: sum(n) for i, n in texts.items()}
    assert corpus_pipeline.run(spark, folder).count() == left[-1]


def exact_dedup_key(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_a_line_in_a_twentieth_of_a_hot_host_goes(spark):
    shared = "this page of the site was made by a machine and says so on many of its pages"
    words = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    rows = [(i, f"{words(i, 60)}\n{shared}\n {shared.upper()}" if i < 100 else words(i, 80), "hot") for i in range(2000)]
    notes = "\n".join(" ".join(f"note{k}of{j}" for k in range(20)) for j in range(4))
    rows += [(3000 + i, f"{notes}\n{words(3000 + i, 20)}", "hot") for i in range(21)]  # little is left of these
    rows += [(4000 + i, f"{words(4000 + i, 60)}\n{shared}", None) for i in range(20)]  # another host, at its limit
    rows += [(5000, rows[0][1], "hot")] * 30 + [(6000 + i, f"{shared}\n{words(0, 60)}", "copies") for i in range(50)]
    got = {r.doc_id: r for r in line_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    n = len(shared.split())
    assert {got[i].n_words - got[i].n_left_words for i in [*range(100), 5000]} == {2 * n}
    assert all(got[i].n_left_words == got[i].n_words for i in got if 100 <= i < 3000 or 4000 <= i != 5000)
    assert {(got[i].n_left_words, got[i].base_failed, got[i].kept) for i in range(3000, 3021)} == {(20, False, False)}
    assert all(r.kept for i, r in got.items() if i < 3000)


def test_short_notices_by_their_key_phrases(spark):
    texts = {
        "Released with a mit license text": "mit", "mit license": "mit", "CC0 1.0 Universal": "cc0", "cc0 1 0": "cc0",
        "mozilla public license v 2 0": "mpl-2", "license mit": "", "cc0 1": "", "": "",
        "mit mit license license; see cc0 1 1 0 and cc0 1 0": "cc0,mit",
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 3": "lgpl-3",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(texts.values()))
    assert {r.doc_id: r.labels for r in license_scan.scan(docs).collect()} == want
    crowd = spark.createDataFrame([(100 + i, "cc0 and mit 1 0 0 license") for i in range(30)], "doc_id long, text string")
    for n_rare in (1, 3):  # neither other files nor the number of looked-up words change what is found
        got = {r.doc_id: r.labels for r in license_scan.scan(docs.union(crowd), n_rare=n_rare).collect()}
        assert {i: got[i] for i in want} == want


def test_the_sample_is_the_same_however_rows_are_dealt(spark):
    words = {"en": "the cat and the dog", "de": "der hund und die katze", "fr": "le chat et le chien"}
    rows = [(i, f"{words[x]} {i}", x) for x in words for i in range(*{"en": (0, 90), "de": (90, 120), "fr": (120, 128)}[x])]
    rows += [(3, "another text of the same document", "en"), (95, "noch ein text", "de")]  # repeated ids
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = [language_id.fit(d, F.lit(True), per_language=10) for d in (docs.repartition(40), docs.coalesce(1))]
    assert all(np.array_equal(m.weights, models[0].weights) for m in models) and models[0].weights.any()
    least = docs.filter("lang = 'en'").select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(10).collect()
    only = docs.filter(~(F.col("lang") == "en") | F.col("doc_id").isin([r.doc_id for r in least]))
    assert np.array_equal(language_id.fit(only, F.lit(True), per_language=10).weights, models[0].weights)


# --- memory of the workers -----------------------------------------------------------------

def test_a_task_hands_on_its_tokens_before_it_has_many():
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(20_000)) for i in range(40)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    parts = list(ngram_join._token_blobs(5, 8)(iter([batch])))
    sizes = [sum(len(t.as_py()) for t in p.column("tokens")) // 4 for p in parts]
    assert sum(sizes) == 40 * (20_000 - 4) and max(sizes) < 600_000


def test_an_encoder_remembers_no_more_than_told():
    texts = [f"{a}{b} and {b}{a} 1{a}" for a in ("cat", "dog", "bird") for b in ("sun", "moon", "star")]
    few = packing.PieceEncoder(TOKENIZER, remembered=5)
    every = packing.PieceEncoder(TOKENIZER)
    for _ in range(2):
        assert few.ids(texts) == every.ids(texts)
    assert len(few.known) == 5 < len(every.known)


def test_stages_take_texts_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(48, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    try:
        rows = corpus_pipeline.in_small_batches(lambda s, d, _: d.mapInArrow(sizes, "n bigint"))(spark, docs, "").collect()
        assert sum(r.n for r in rows) >= 48 << 20 and max(r.n for r in rows) <= corpus_pipeline.BATCH_BYTES + (2 << 20)
        assert all(stage.__wrapped__ for _, stage in corpus_pipeline.STAGES)
    finally:
        spark.conf.unset(key)
