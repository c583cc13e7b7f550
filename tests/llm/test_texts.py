"""Operators on single texts: BPE, HTML, syncmers, licenses, toxicity."""

import random
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from riskloom.llm import byte_bpe, common, html_blocks, license_scan, syncmers, toxicity

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ODD = ["", "a", " ", "\n\n", "naïve café 漢字 🙂🙂", "x" * 70_000, "ab " * 20_000, "it's we'll 12345 $$ \t\tend  ", "<|endoftext|>", "\x1c\x85　"]


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_bpe_equals_plain_merging(codec, plain):
    rnd = random.Random(5)
    texts = ODD + ["".join(rnd.choice(a) for _ in range(rnd.randint(0, 80)))
                   for a in ("abcdefgh ", "the ing er ", "éß漢🙂 a", "aA1 \n\t.'s") for _ in range(500)]
    for text in texts:
        packed = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == plain.encode_ordinary(text), text[:50]
        assert codec.decode(packed) == text


def test_bpe_beyond_its_memos(plain, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_STATES", 20)
    monkeypatch.setattr(byte_bpe, "MEMO_BYTES", 1_000)
    small = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for text in ["thandonerheti ofquemente schlichkeitung"] * 2 + ODD[:5]:
        assert np.frombuffer(small.encode(text), "<u4").tolist() == plain.encode_ordinary(text)


def test_utf8_stream_equals_python():
    rnd = random.Random(1)
    for _ in range(3000):
        raw = bytes(rnd.choice([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF, 0xC0]) for _ in range(8))
        stream = byte_bpe.Utf8Stream()
        assert "".join(stream.feed(raw[i:i + 3]) for i in range(0, 8, 3)) + stream.close() == raw.decode("utf-8", "replace")


def test_bpe_frames(spark, docs, clash):
    bpe = byte_bpe.ByteBpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = bpe.decode(bpe.encode(clash(docs([None, "", "a b", "a b"])), ids="ids")).orderBy("doc_id").collect()
    assert [r.decoded for r in rows] == ["", "", "a b", "a b"] and rows[0].ids == b""
    both = bpe.round_trip(clash(docs([None, "", "a b", "a b"])), ids="ids").orderBy("doc_id").collect()
    assert [(r.ids, r.decoded) for r in both] == [(r.ids, r.decoded) for r in rows]
    assert bpe.decode(bpe.encode(docs([]))).count() == 0 and bpe.round_trip(docs([])).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href=/>Home</a></li></ul></nav><!-- x --><div class="ad">Buy this now, it is really very good and cheap.</div>
%s<footer>&copy; Somebody and a long line of text that says nothing about anything at all.</footer></body></html>"""


@pytest.mark.parametrize("body, text", [
    ("<article><h1>Head &amp; more</h1><p><b>One  two\n three<br><p>Short.</p></article>", "Head & more\nOne two three\nShort."),
    ("<article><p>Kept.</p><aside>no</aside><form>no</form><div id='comments'><p>no</p></div><p>Too.</p></article>", "Kept.\nToo."),
    ("<div class='cookie-notice'>We use</div><div><p>" + "long text " * 12 + "</p><p>End.</p></div>", ("long text " * 12).strip() + "\nEnd."),
    ("<article></article>", ""),
    ("<div class=ad>open<article><p>Still here.</p></article>", "Still here."),
])
def test_html_main_text(body, text):
    assert html_blocks.main_text(PAGE % body) == text


LINKS = "<ul>" + "<li><a href=/x>One of many links to other pages</a></li>" * 4 + "</ul>"
LONG = "long text " * 12


@pytest.mark.parametrize("tag", ["article", "main", "div"])
@pytest.mark.parametrize("body, text", [
    ("<h1>A short page</h1><div><p>Of two lines.</p></div>", "A short page\nOf two lines."),
    ("<div><div><h1>Head</h1></div></div><div><div><p>" + LONG + "</p></div></div><div><ul><li>One</li></ul></div><div><h2>Next</h2></div>"
     "<div><p>Short.</p></div>", f"Head\n{LONG.strip()}\nOne\nNext\nShort."),
    ("<p>" + LONG + "</p><aside>no</aside><p>Beside.</p><form>no</form><p>Between.</p><aside>no</aside><p>Three.</p><form>no</form><p>" + LONG + "</p>",
     f"{LONG.strip()}\nBeside.\nBetween.\nThree.\n{LONG.strip()}"),
    ("<p>" + LONG + "</p><p><a href=/>A link</a></p><p>End.</p>", f"{LONG.strip()}\nA link\nEnd."),
])
def test_html_main_text_needs_no_article_tag(tag, body, text):
    assert html_blocks.main_text(PAGE % f"<{tag}>{body}</{tag}>") == text


@pytest.mark.parametrize("body, text", [
    ("<article><p>" + LONG + "</p></article><div><p>Outside. " + LONG + "</p></div>", f"{LONG.strip()}\nOutside. {LONG.strip()}"),
    ("<article><p>" + LONG + "</p></article>" + LINKS + "<div>Small print</div>", LONG.strip()),
    ("<div>Slogan</div>" + LINKS + "<div><p>" + LONG + "</p></div>", LONG.strip()),
    ("<article><p>" + LONG + "</p>" + LINKS + "</article>", "\n".join([LONG.strip()] + ["One of many links to other pages"] * 4)),
])
def test_html_windows_decide_beside_an_article(body, text):
    assert html_blocks.main_text(PAGE % body) == text


BODY = "<p>" + LONG + "</p><p>short</p>"


@pytest.mark.parametrize("part", [
    '<article class="post no-sidebar">%s</article>', '<div class="wrapper sidebar-right">%s</div>', '<div class="lesson social-studies">%s</div>',
    '<div class="page no-comments">%s</div>', '<article class="sidebar">%s</article>', '<div class="post"><div class="has-banner">%s</div></div>',
])
def test_html_a_part_that_holds_the_text_stays_whatever_it_is_called(part):
    assert html_blocks.main_text(PAGE % (part % BODY)) == LONG.strip() + "\nshort"


@pytest.mark.parametrize("body, text", [
    ("<div>" + BODY + '<div class="comments"><p>' + 3 * LONG + '</p></div><div class="comment-list">Me too</div></div>', LONG.strip() + "\nshort"),
    ("<article>" + BODY + '</article><article class="comment"><p>' + 3 * LONG + "</p></article>", LONG.strip() + "\nshort"),
    ("<div><p>" + LONG + "</p><aside>x</aside><p>one</p><aside>x</aside><p>two</p><aside>x</aside><p>three</p></div><p>(c) 2024 Somebody</p>",
     LONG.strip() + "\none\ntwo\nthree"),
    ('<div><p>' + LONG + '<a title="a > b" href=x>link</a> &lt;p&gt; 1 < 2</p></div>', LONG + "link <p> 1 < 2"),
])
def test_html_ends_of_an_article_and_what_stands_around_it(body, text):
    assert html_blocks.main_text(PAGE % body) == text


def test_html_text_without_tags_is_text():
    assert [html_blocks.main_text(t) for t in ("x" * 79, "x" * 80, "<b>a</b> b", "<p>a</p>")] == ["x" * 79, "x" * 80, "a b", "a"]


@pytest.mark.parametrize("attack", ["<a ", '<a "', "<!", "<!--", "<", "</div>", "<script ", '<a href="', '<div class="no-sidebar">', "<div>x", "<p>&", "<a href=x>"])
def test_html_reading_is_linear(attack):
    import time

    took = []
    for size in (100_000, 400_000):
        started = time.process_time()
        html_blocks.main_text(attack * (size // len(attack)))
        took.append(time.process_time() - started)
    assert took[1] < 12 * took[0] + 0.5


def test_html_pages_of_the_table_with_article_as_div(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    for page in pages:
        assert html_blocks.main_text(page.replace("<article", "<div").replace("</article", "</div")) == html_blocks.main_text(page) != ""


def test_html_frames(spark, clash):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<p"), (4, PAGE % ("<article><p>" + "w " * 50_000 + "</p></article>")), (4, "x")],
                                  "page_id long, html string")
    rows = [r.text for r in html_blocks.extract(clash(pages)).orderBy("page_id", F.length("html").desc()).collect()]
    assert rows[0] == rows[1] == "" and len(rows[3]) == 99_999 and rows[4] == "x"
    assert html_blocks.extract(pages.limit(0)).count() == 0


def _plain_anchors(text):
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text) if w]
    return words, len(words) - syncmers.K + 1


def test_syncmers_are_context_free_and_positional(spark, docs):
    passage = " ".join(f"w{i * 7919 % 1000}" for i in range(60))
    frame = docs([passage, "other words before " + passage + " and after it"])
    found = {}
    for r in syncmers.anchors(frame).collect():
        found.setdefault(r.doc_id, {})[r.position] = r.anchor
    assert {p + 3: a for p, a in found[0].items()}.items() <= found[1].items()
    assert 0.4 < len(found[0]) / _plain_anchors(passage)[1] < 0.95


def test_edited_texts_and_fingerprints(spark, docs, clash, monkeypatch):
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", 7)
    texts = [None, "", "one", "x y z"] + [" ".join(f"w{i}{j}" for j in range(20 + i)) for i in range(40)] + ["same text here twice"] * 2 + ["é🙂" * 9000]
    rows = {r.doc_id: r for r in syncmers.compare_edited(clash(docs(texts))).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        t, following = t or "", texts[(i + 1) % len(texts)] or ""
        cut = len(t) // 4
        assert rows[i].edited == t[:len(t) - cut] + following[:cut], i
        assert 0 <= rows[i].near_edited <= 1
    same = [i for i, t in enumerate(texts) if t == "same text here twice"]
    assert rows[same[0]].fingerprint == rows[same[1]].fingerprint and rows[same[0]].near_next == 1.0
    assert rows[0].fingerprint == "" and rows[0].near_next == 1.0
    assert syncmers.compare_edited(docs([])).count() == 0
    assert syncmers.compare_edited(docs(["alone and only"])).first().near_next == 1.0


def test_likeness_and_fingerprint_cover_the_whole_text(spark, docs):
    rnd = random.Random(3)
    words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(5000)]
    passage = [f"p{rnd.randrange(10 ** 6)}" for _ in range(50)]
    again = words[:2000] + [f"e{i}" for i in range(20)] + words[2020:]                    # 20 words edited
    shared = [f"v{rnd.randrange(10 ** 6)}" for _ in range(5000)] + passage
    texts = [" ".join(t) for t in (words, again, words + passage, shared, passage * 3, passage * 4)]
    found = {i: set() for i in range(len(texts))}
    for r in syncmers.anchors(docs(texts)).collect():
        found[r.doc_id].add(r.anchor)
    rows = {r.doc_id: r for r in syncmers.compare_edited(docs(texts)).collect()}
    for i in found:
        a, b = found[i], found[(i + 1) % len(texts)]
        assert rows[i].near_next == pytest.approx(len(a & b) / len(a | b))
    assert 0.98 < rows[0].near_next < 1 and 0 < rows[2].near_next < 0.01
    assert len({r.fingerprint for r in rows.values()}) == len(texts)
    for r in rows.values():
        assert r.fingerprint[32:] == "".join(f"{x:08x}" for x in sorted(found[r.doc_id])[:64])


def test_license_scan_equals_brute_force(spark, docs, clash):
    rnd = random.Random(2)
    filler = lambda n: " ".join(rnd.choice(["alpha", "beta", "gamma", "the", "license", "under"]) for _ in range(n))
    names = sorted(license_scan.NOTICES)
    texts = [None, "", "too short", "MIT License"] + [filler(rnd.randint(0, 90)) + "\n" + license_scan.NOTICES[rnd.choice(names)].upper() + " " + filler(rnd.randint(0, 90))
                                                      for _ in range(60)]
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    shingle = lambda w: [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    got = {r.doc_id: r.licenses for r in license_scan.scan_documents(clash(docs(texts))).collect()}
    for i, t in enumerate(texts):
        sh, want = shingle(words(t)), []
        for name in names:
            own = set(shingle(words(license_scan.NOTICES[name])))
            size = 1 << (len(own) - 1).bit_length()
            if any(len(own & set(sh[b:b + 2 * size])) >= license_scan.CONTAINED * len(own) for b in range(0, max(1, len(sh)), size)):
                want.append(name)
        assert got[i] == ",".join(want), i
    assert license_scan.scan_documents(docs([])).count() == 0


def test_full_license_texts_edited_and_partial(spark, docs):
    from importlib.resources import files

    texts = {f.name[:-4]: f.read_text(encoding="utf-8").split() for f in (files("riskloom.llm") / "license_texts").iterdir()}
    assert len(license_scan.all_templates()) <= license_scan.MAX_TEMPLATES and len(texts) >= 14
    planted = []
    for name, words in sorted(texts.items()):
        edited = [("edited" if i % 60 == 30 else w) for i, w in enumerate(words)]
        middle = max(0, len(words) // 2 - 40)
        planted += [(f"{name}-text", " ".join(t)) for t in (words, ["before"] * 17 + edited + ["after"] * 9, words[middle:middle + 90])]
    planted += [(name, "Some words. " + text + " More words.") for name, text in license_scan.HEADERS.items()] + [("", "plain words " * 200)]
    rows = {r.doc_id: r for r in license_scan.scan_documents(docs([t for _, t in planted]), license_scan.all_templates()).collect()}
    for i, (name, _) in enumerate(planted):
        assert name in rows[i].licenses.split(","), (i, name, rows[i].licenses)
        assert rows[i].n_licenses == (len(rows[i].licenses.split(",")) if name else 0)


def test_bands_give_the_promised_collisions():
    for size in (1, 2, 4, 8, 16, 32):
        shortest = size // 2 + 1 if size > 1 else 1
        common = -(-3 * shortest // 4)
        least = common / (2 * size + shortest - common)
        assert 1 - (1 - least) ** license_scan.bands_for(size) >= license_scan.COLLISION


CLEAN = ["the weather in the north is mild today and people walk", "she reads a long book about rivers and mountains", "we cook rice and beans on sunday evening"]
TOXIC = ["you idiot go away from the river", "that moron reads a book", "stupid idiot people walk today", "what a stupid moron in the north"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, CLEAN[i % 3] + f" {i}", 0) for i in range(120)] + [(200 + i, TOXIC[i % 4], 1) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.ToxicityModel.fit(frame, frame)


def test_disguised_words_are_restored_and_scored(spark, docs, clash, model):
    texts = ["an 1d10t indeed", "i d i o t", "iiidiooot here", "m.o.r.o.n", "5tup!d", "a m0r0n", "STUPID", None, "", *CLEAN, "a a a a a a", "x" * 60_000, "1 " * 20_000]
    rows = {r.doc_id: r for r in model.score(clash(docs(texts))).collect()}
    assert [rows[i].predicted for i in range(len(texts))] == [1] * 7 + [0] * (len(texts) - 7)
    restored = {r.doc_id: r.restored for r in model.restore(docs(texts[:3])).collect()}
    assert restored == {0: "an idiot indeed", 1: "idiot", 2: "idiot here"}
    assert model.score(docs([])).count() == 0


def test_disguises_together_are_restored(model):
    decoder = toxicity.Decoder(model.sent.value[0])
    read = lambda t: toxicity.restore_text(decoder, t)
    spaced = ["i d i o t.", "(i d i o t!)", "i d ! o t", "1 d 1 0 t", "i  d  i   o t", "i\td\ni o t", "i . d . i . o . t", "i.d.!.o.t", "i - d - i - o - t",
              "iii d i ooo t", "i i d i o o o t", "i i d ! o 0 t,"]
    assert [read(t) for t in spaced] == ["idiot"] * len(spaced)
    assert [read(t) for t in ("$ t u p ! d", "m 0 r 0 n", "m o r * n", "r u n", "* * *")] == ["stupid", "moron", "moron", "run", "* * *"]
    assert read("y o u   i d ! o t ,  g o a w a y") == "you idiot go away"


def test_long_spans_are_one_lattice(model, monkeypatch):
    decoder = toxicity.Decoder(model.sent.value[0])
    for n in range(20):
        letters = ("andbeans" * 5)[:20 + n] + "youidiotgoaway"
        assert "idiot" in toxicity.restore_text(decoder, " ".join(letters)), n
        assert "youidiotgoaway" in toxicity.restore_text(decoder, "1t" + letters * 2), n
    span = " ".join("the river and stupid idiot people walk today. 1".replace(" ", "") * 200)
    whole = decoder._viterbi(span)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert decoder._viterbi(span) == whole and whole.count("idiot") == 200


def test_without_labels_of_both_kinds_every_score_is_zero(spark, docs):
    frame = docs(CLEAN).withColumn("toxic", F.lit(0))
    assert {r.score for r in toxicity.ToxicityModel.fit(frame, frame).score(docs(TOXIC)).collect()} == {0.0}
    nothing = docs([]).withColumn("toxic", F.lit(0))
    assert {r.score for r in toxicity.ToxicityModel.fit(nothing, nothing).score(docs(TOXIC)).collect()} == {0.0}



def test_held_out_labels_are_found(spark):
    """Labels the model never saw, on the given tables."""
    from riskloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op1_toxicity"].run(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = got.filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n.get((1, 1), 0) >= 0.8 * (n.get((1, 1), 0) + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.02 * n[0, 0]


def test_bpe_remembers_the_moves_of_many_new_words(plain, monkeypatch):
    rnd = random.Random(9)
    parts = ["".join(rnd.choice("etaoinsrhdlcéß") for _ in range(rnd.randint(1, 5))) for _ in range(2_000)]
    text = " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(2, 5))) for _ in range(20_000))
    codec = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    slow = []
    unkept = codec.machine._unkept
    monkeypatch.setattr(codec.machine, "_unkept", lambda *a: slow.append(a) or unkept(*a))
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == plain.encode_ordinary(text)
    assert not slow      # words made of known parts lead through moves that are remembered


def test_gram_counts_hold_one_block_at_a_time(monkeypatch):
    texts = ["Ünïdiot 1d-iot\n.", "", "ab", "zz Ab", " end"]
    whole = toxicity.gram_counts(iter(texts))
    for size in (1, 2, 5):
        monkeypatch.setattr(toxicity, "GRAM_BLOCK", size)
        assert (toxicity.gram_counts(iter(texts)) == whole).all()
    monkeypatch.undo()
    long = ["many words of a long text " * 80_000] * 2
    tracemalloc.start()
    toxicity.gram_counts(iter(long))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000


def test_a_worker_keeps_one_model():
    toxicity._decoder(np.zeros(toxicity.CELLS, np.int64).tobytes())
    codec = byte_bpe._codec(b"YQ== 0\n", "a")
    assert byte_bpe._codec(b"YQ== 0\n", "a") is codec
    assert list(common._model.values()) == [codec]
    common.release_model()
    assert not common._model
