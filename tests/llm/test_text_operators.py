"""Chat formatting, decontamination, extraction, token files, pieces and fingerprints."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from helpers import corpus, documents, prose
from tokenizers import Tokenizer

from rulecast.llm.chat_formatting import format_conversations, read_conversations
from rulecast.llm.decontamination import find_contamination
from rulecast.llm.html_extraction import extract_main_text, main_text
from rulecast.llm.phrase_fingerprints import as_text, fingerprint, fingerprint_documents, fingerprint_edits, from_text, likeness
from rulecast.llm.piece_encoding import PieceModel, decode_pieces, encode_pieces
from rulecast.llm.token_files import encode_documents, read_metadata, read_tokens, with_checksum, write_tokens

TURNS = "conv_id bigint, turn bigint, role string, text string, formatted string, rows string"


def test_conversations_come_back(spark):
    rows = [(1, 2, "assistant", "b\\0 [TURN] </s>"), (1, 0, "system", None), (1, 1, "user", "a"), (1, 3, "assistant", "\\"), (1, 3, "assistant", "\\"),
            (2, 0, None, "[INST user]"), (None, 1, "user", ""), (3, 5, "assistant", ""), (1, None, "x]y", "<<")]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], TURNS)
    found = read_conversations(format_conversations(df)).collect()
    want: dict = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (-10 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in found} == want
    one = next(r for r in found if r.conv_id == 1)
    assert "".join(s.text for s in one.segments) == one.formatted and one.formatted.count("[INST assistant]") == 1
    assert [s.text for s in one.segments if s.loss] == ["b\\00 \\1TURN\\2 \\3/s>", "\\0", "\\0"]
    assert format_conversations(df.limit(0)).collect() == []


def windows(text, width=13):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(width, len(words))
    return words, {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def test_contamination_equals_brute_force(spark):
    rnd = random.Random(3)
    items = [(i, prose(rnd, rnd.randint(10, 40))) for i in range(12)] + [(50, "kappa1"), (51, None), (52, "..."), (53, "Alpha1 beta2 Gamma3"), (53, "Alpha1 beta2 Gamma3")]
    docs = []
    for i in range(60):
        item = rnd.choice(items)[1] or ""
        words = item.split()
        a = rnd.randint(0, len(words))
        docs.append((i, f"{prose(rnd, rnd.randint(0, 60))} {' '.join(words[a : a + rnd.randint(1, 30)]).upper()}! {prose(rnd, 5)}"))
    docs += [(100, None), (101, ""), (102, "x alpha1, BETA2 gamma3"), (102, "x alpha1, BETA2 gamma3"), (103, "É" * 2000)]
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in items], "item_id bigint, text string, fp string, item string, doc_id string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in find_contamination(documents(spark, docs), df).collect())
    want = []
    for i, text in docs:
        words, _ = windows(text)
        hit, found = set(), set()
        for item, said in items:
            _, wanted = windows(said)
            for w in wanted:
                for k in range(len(words) - len(w) + 1):
                    if tuple(words[k : k + len(w)]) == w:
                        hit.update(range(k, k + len(w)))
                        found.add(str(item))
        want.append((i, len(words), len(hit), tuple(sorted(found))))
    assert got == sorted(want)
    assert all(r.n_hit == 0 for r in find_contamination(documents(spark, docs), df.limit(0)).collect())
    assert find_contamination(documents(spark, []), df).collect() == []


def test_contamination_of_rows_that_share_an_id(spark):
    shared = " ".join(f"s{k}" for k in range(20))
    docs = [(1, shared), (1, "a clean text " * 9), (None, f"x {shared} y"), (None, None), (None, f"x {shared} y"), (2, "")]
    items = spark.createDataFrame([(7, shared), (8, f"{shared} more"), (None, shared), (9, "s3 s4"), (10, None), (7, shared)], "item_id bigint, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"], r.spans) for r in find_contamination(documents(spark, docs), items).collect())
    whole = (20, ["7", "8", "9"], [[0, 20]])
    inner = (20, ["7", "8", "9"], [[1, 21]])
    assert got == sorted([("1", 20, *whole), ("1", 27, 0, [], []), ("None", 22, *inner), ("None", 22, *inner), ("None", 0, 0, [], []), ("2", 0, 0, [], [])])


def test_contamination_by_a_common_line_and_a_common_passage(spark):
    rnd = random.Random(8)
    line, passage = "one very common line of words", prose(rnd, 30)
    items = [(str(k), f"{prose(rnd, 9)} {line} {prose(rnd, 9)} {passage if k % 3 == 0 else ''}") for k in range(60)]
    docs = [(k, f"{prose(rnd, 9)} {line} {prose(rnd, 9)} {passage if k % 2 == 0 else ''}") for k in range(200)]
    found = find_contamination(documents(spark, docs), spark.createDataFrame(items, "item_id string, text string")).collect()
    lists = sorted(str(k) for k in range(0, 60, 3))
    assert all((r.n_hit, r["items"]) == ((len(windows(passage)[0]), lists) if r.doc_id % 2 == 0 else (0, [])) for r in found)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body class="has-sidebar">
<div id="cookie-notice"><p>We use cookies, %(long)s</p></div><header><a href="/">Home</a></header>
<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li><li><a>Four</a></li></ul>
<div class="post"><h1>The&nbsp;title &amp; more</h1><p>First <b>par</b>agraph,
%(long)s</p><p>Short.</p><div class="ad">Buy now, %(long)s</div><p>a &lt; b &amp;amp; c < d</p></div>
<div class="comments"><p>Reader: %(long)s</p></div><form><p>%(long)s</p></form><footer>(c) us</footer></body></html>"""


def test_main_text_without_article_element():
    long = "words and words " * 12
    page = PAGE % {"long": long}
    assert main_text(page) == f"The title & more\n\nFirst paragraph, {long.strip()}\n\nShort.\n\na < b &amp; c < d"
    inside = page.replace('<div class="post">', "<article>").replace("c < d</p></div>", "c < d</p></article>")
    assert main_text(inside) == f"The title & more\n\nFirst paragraph, {long.strip()}\n\nShort.\n\na < b &amp; c < d"


def test_main_text_beside_article_elements():
    long = "words and words " * 12
    said = f"Title\n\n{long.strip()}"
    body = f"<div class=body><h1>Title</h1><p>{long}</p></div>"
    card = '<article class="card"><h3>Another post</h3><p>Read on.</p></article>'
    comment = f'<article class="comment-body" id="comment-7"><p>Reader: {long}</p></article>'
    links = "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li></ul>"
    assert main_text(f"<body>{body}{card}{card}</body>") == said
    assert main_text(f"<body>{body}<section id=comments>{comment}{comment}</section></body>") == said
    assert main_text(f"<body>{body}<article><p>Teaser one.</p></article><article><p>Teaser two.</p></article></body>") == said
    assert main_text(f"<body><p>My site</p><article><h1>Title</h1><p>{long}</p>{links}<p>End.</p>{comment}</article><p>Small print</p></body>") == f"{said}\n\nOne\n\nTwo\n\nThree\n\nEnd."
    assert main_text(f"<body>{body}{links}<article class='post'><p>{long}</p></article>{card}</body>") == f"{said}\n\n{long.strip()}"
    assert main_text('<article class="card"><h1>Title</h1><p>All there is.</p></article>') == "Title\n\nAll there is."
    assert main_text(f"<article><p>Short.</p></article><div><p>{long}</p></div>") == f"Short.\n\n{long.strip()}"


def test_main_text_keeps_weak_lines_of_the_body():
    long = "words and words " * 12
    links = "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li></ul>"
    form, ad = f"<form><p>{long}</p></form>", '<div class="ad">Buy now</div>'
    page = PAGE % {"long": long}
    assert main_text(page) == f"The title & more\n\nFirst paragraph, {long.strip()}\n\nShort.\n\na < b &amp; c < d"
    for between in (form + ad, ad, links, form + links):
        parts = f"<p>First.</p>{between}<p>{long}</p>{between}<p>Middle.</p>{between}<p>{long}</p>{between}<ul><li>Last.</li></ul>"
        want = f"First.\n\n{long.strip()}\n\nMiddle.\n\n{long.strip()}\n\nLast."
        assert main_text(f"<body><div><p>Welcome</p></div>{links}<div class=post>{parts}</div>{links}<div><p>Bye</p></div></body>") == want
    for between in (ad, links):
        assert main_text(f"<div><p>Few.</p>{between}<p>Words.</p>{ad}</div>") == "Few.\n\nWords."


def test_main_text_reads_whole_tokens_of_class_and_id():
    long = "words and words " * 12
    said = f"Title\n\n{long.strip()}"
    body = f"<h1>Title</h1><p>{long}</p>"
    for name in ("layout has-sidebar", "no-sidebar", "with-nav", "widget", "sidebar-left", "comments"):
        assert main_text(f'<body><div class="{name}">{body}</div><footer>us</footer></body>') == said
    assert main_text(f"<body><form action=/ id=aspnet>{body}</form></body>") == said
    for element, inside in (("article", "id"), ("div", "id"), ("div", "class")):
        page = f'<{element}>{body}<section {inside}="related-work"><p>Others.</p></section><h2 id="search-results">Found</h2><p>This.</p></{element}>'
        assert main_text(page) == f"{said}\n\nOthers.\n\nFound\n\nThis."
    page = f'<article>{body}<section id="search"><h2>Search</h2><p>How it works.</p></section><h2 id="menu">Menu</h2><p>Soup.</p></article>'
    assert main_text(page) == f"{said}\n\nSearch\n\nHow it works.\n\nMenu\n\nSoup."
    for name in ("ad", "ads-top", "related-posts", "cookie-bar", "site-nav", "share-buttons", "comments-area"):
        assert main_text(f'<div>{body}</div><div id="{name}"><p>{long[:-20]}</p></div>') == said
    assert main_text(f"<article>{body}</article><div class=comments>{f'<p>{long}</p>' * 9}</div>") == said
    assert main_text(f'<article><p>Short.</p></article><div class="ad">{long}</div>') == "Short."


def test_main_text_of_odd_pages(spark):
    assert [main_text(x) for x in (None, "", "<nav>only</nav>", "plain", "<p>a<p>b", "<nav><p>unclosed menu", "<" * 50)] == ["", "", "", "plain", "a\n\nb", "unclosed menu", "<" * 50]
    assert main_text("<p>" + "x y\n" * 50_000) == " ".join(["x y"] * 50_000)
    pages = spark.createDataFrame([(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>é", "x")], "page_id bigint, url string, html string, text string")
    assert sorted(map(tuple, extract_main_text(pages).collect()), key=repr) == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "é", 1)], key=repr)
    assert extract_main_text(pages.limit(0)).collect() == []


def test_encoding_holds_few_bytes_for_each_id():
    import tracemalloc

    from rulecast.llm.token_files import WordEncoder

    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.encode(pa.array(["the cat"]), 1)  # what is loaded once does not count
    tracemalloc.start()
    try:
        ids, size = encoder.encode(pa.array(["the cat sat on a mat " * 50_000]), 1)
        assert len(ids) == size[0] == 300_001 and tracemalloc.get_traced_memory()[1] < 30 * len(ids)
    finally:
        tracemalloc.stop()


def test_token_files_equal_the_library(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = corpus() + [(3000, "Don't <|endoftext|> É̈ ϲ Σς\x0b漢字 İ ﬁ's 12ab"), (3001, "ÀB, the. The ST")]
    write_tokens(encode_documents(documents(spark, rows), path, 1, 3), str(tmp_path / "t"))
    got = sorted(tuple(r) for r in with_checksum(read_tokens(spark, str(tmp_path / "t"))).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    tokenizer, at, want = Tokenizer.from_file(path), 0, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    plan = read_metadata(spark, str(tmp_path / "t"))._jdf.queryExecution().executedPlan().toString()
    assert "array<int>" not in plan and "ReadSchema: struct<shard:int,doc_id:bigint" in plan
    assert encode_documents(documents(spark, []), path, 1).collect() == []
    twice = encode_documents(documents(spark, [(1, "a"), (1, "a"), (None, "b")]), path, 1).collect()
    assert [r.doc_id for r in twice] == [None, 1, 1]


def test_pieces_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(1)
    vocabulary = [library.id_to_piece(i).replace("▁", " ") for i in range(300, 32000, 7)]
    said = [t or "" for _, t in corpus()] + ["a▁ b", "    x     y  ", "\n\n a", "漢字 😀 ̀x", "<s> </s> <0x0A>", "ab" * 400]
    said += ["".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    ids, counts = PieceModel(path).encode_column(pa.array(said))
    at = np.concatenate(([0], np.cumsum(counts)))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == library.encode(said)
    rows = [(i, t) for i, t in enumerate(said[:60])] + [(None, None), (7, "x"), (7, "x")]
    got = decode_pieces(encode_pieces(documents(spark, rows), path), path).collect()
    assert sorted(((r.doc_id, r.ids, r.text) for r in got), key=repr) == sorted(((i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in rows), key=repr)
    assert encode_pieces(documents(spark, []), path).collect() == []
    broken = [[3 + 0xE2, 3 + 0x82, 3 + 0x41], [0, 5, 1], [259 + 100, 2], []]
    odd = spark.createDataFrame([(i, x) for i, x in enumerate(broken)], "doc_id bigint, ids array<int>")
    assert [r.text for r in sorted(decode_pieces(odd, path).collect())] == [library.decode(x) for x in broken]


def test_fingerprints_equal_brute_force(spark):
    rows = corpus(n=25)
    got = {r.doc_id: r for r in fingerprint_edits(documents(spark, rows)).collect()}
    ordered = sorted(rows)
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, other = fingerprint(text), fingerprint(edited)
        want = (len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(own), as_text(other), likeness(own, other), likeness(own, fingerprint(after)))
        assert tuple(got[i])[1:] == want and from_text(got[i].fingerprint) == own
    plain = fingerprint_documents(documents(spark, [(None, None), (1, "aaa"), (1, "aaa")])).collect()
    assert sorted(((r.doc_id, r.n_chars) for r in plain), key=repr) == [(1, 3), (1, 3), (None, 0)]
    assert fingerprint_edits(documents(spark, [])).collect() == []
    assert [(r.doc_id, r.near_next) for r in fingerprint_edits(documents(spark, [(1, "abc"), (None, "x")])).collect()] == [(1, 1.0)]
