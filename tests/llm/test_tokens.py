"""BPE, unigram counts, scoring and extraction against libraries, formulas and hand-made pages."""

import hashlib
import math
import random
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from stayledger.llm import bpe, html_extract, lm_scoring, token_count
from tests.llm.rows import EDGES, documents

POOL = "aaaabcdeeeehilmnoorsttt  '''.,!0123ÉéßñçİΣσς \n\t日本語😀<|endoftext|>́É\u0085▁"


def texts():
    pick = random.Random(1)
    made = ["".join(pick.choice(POOL) for _ in range(pick.randint(0, 40))) for _ in range(3000)]
    return made + ["<|endoftext|>a<|startoftext|><|endoftext|>", "It's we'll", "x" * 5000, *(t for _, t in EDGES if t)]


def test_bpe_is_the_library_s(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(bpe.FILE))
    encoder = bpe.Encoder(bpe.compiled(public_tokenizers.path(bpe.FILE)))
    for text in texts():
        words = list(encoder.words(text))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert b"".join(w[0] for w in words) == b"".join(i.to_bytes(4, "little") for i in ids), text
        assert " ".join(w[1] for w in words) == tokenizer.decode(ids, skip_special_tokens=False)
    got = bpe.encoded(documents(spark, EDGES, extra=True), public_tokenizers.path(bpe.FILE)).collect()
    wanted = Counter()
    for d, text in EDGES:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        wanted[d, len(ids), digest, hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == wanted
    assert bpe.encoded(documents(spark, []), public_tokenizers.path(bpe.FILE)).count() == 0


def test_unigram_counts_are_the_library_s(spark):
    pieces = token_count.vocabulary(public_tokenizers.path(token_count.FILE))
    odd = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256))]
    tokenizer = Tokenizer(models.Unigram([*odd, *pieces], unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = token_count.Counter(pieces)
    for text in texts():
        assert counter.count(text) == len(tokenizer.encode(text).ids), text
    got = token_count.token_counts(documents(spark, EDGES, extra=True), pieces).collect()
    wanted = Counter((d, len(t or ""), len(tokenizer.encode(t or "").ids)) for d, t in EDGES)
    assert Counter(map(tuple, got)) == wanted
    assert token_count.token_counts(documents(spark, []), pieces).count() == 0


def test_ties_go_to_the_longer_last_piece():
    counter = token_count.Counter([("a", -1.0), ("aa", -2.0), ("b", -1.0), ("▁", 0.0)])
    assert counter.viterbi("aa") == 1 and counter.viterbi("aab") == 2


def test_scores_against_the_formula(spark):
    rows = EDGES + [(20 + i, f"red {'green' if i % 3 else 'blue'} red red {i}") for i in range(12)]
    target = spark.createDataFrame([(20,), (23,), (1,), (1,), (None,), (777,)], "doc_id long")
    got = lm_scoring.scored(documents(spark, rows, extra=True), target, vocabulary=5).collect()
    words = [(d, (t or "").lower().split()) for d, t in rows]
    counts = Counter(w for _, ws in words for w in ws)
    top = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w))[:5], 1)}
    ids = [(d, [0, *(top.get(w, 0) for w in ws)]) for d, ws in words]
    pairs = {
        "background": Counter(p for _, x in ids for p in zip(x, x[1:], strict=False)),
        "target": Counter(p for d, x in ids if d in (20, 23, 1) for p in zip(x, x[1:], strict=False)),
    }

    def loss(model, pair, own):
        counts = pairs[model] - own
        total = sum(counts.values()) + 6 * lm_scoring.FLOOR
        single = (sum(n for (_, b), n in counts.items() if b == pair[1]) + lm_scoring.FLOOR) / total
        head = sum(n for (a, _), n in counts.items() if a == pair[0])
        return -math.log((counts[pair] + lm_scoring.PRIOR * single) / (head + lm_scoring.PRIOR))

    wanted = {}
    for d, x in ids:
        many = len(x) - 1
        own = Counter(zip(x, x[1:], strict=False))
        without = {"background": own, "target": own if d in (20, 23, 1) else Counter()}
        means = [sum(n * loss(m, p, without[m]) for p, n in own.items()) / many if many else None for m in ("target", "background")]
        wanted[d, many] = means
    for r in got:
        for value, mean in zip((r["target_loss"], r["background_loss"]), wanted[r["doc_id"], r["n_tokens"]], strict=True):
            assert value == (None if mean is None else pytest.approx(mean, rel=1e-5))
    assert len(got) == len(rows)
    assert lm_scoring.scored(documents(spark, []), target).count() == 0


@pytest.mark.parametrize("held, at_once", [(lm_scoring.PAIRS_HELD, lm_scoring.TEXT_AT_ONCE), (40, 3000)])
def test_scores_know_every_word(spark, monkeypatch, held, at_once):
    monkeypatch.setattr(lm_scoring, "PAIRS_HELD", held)
    monkeypatch.setattr(lm_scoring, "TEXT_AT_ONCE", at_once)
    rows = [r for r in EDGES if r[0] != 5] + [(100 + i, "the cat " * 6 + " ".join(f"rare{i * 100 + k}" for k in range(150))) for i in range(60)]
    rows += [(300, "the cat sat on rare1"), (301, "the cat sat on rare2"), (302, "the")]
    target = spark.createDataFrame([(100 + i,) for i in range(0, 60, 3)] + [(300,), (300,), (None,)], "doc_id long")
    got = lm_scoring.scored(documents(spark, rows, extra=True).repartition(3), target).collect()
    words = [(d, ["", *(t or "").lower().split()]) for d, t in rows]
    size = len({w for _, ws in words for w in ws})
    assert size > 4096
    means = {}
    for model in ("background", "target"):
        inside = [model == "background" or d in {300, *range(100, 160, 3)} for d, _ in words]
        pairs = Counter(p for (_, ws), i in zip(words, inside, strict=True) if i for p in zip(ws, ws[1:], strict=False))
        heads, seconds = Counter(), Counter()
        for (a, b), n in pairs.items():
            heads[a] += n
            seconds[b] += n
        for (d, ws), i in zip(words, inside, strict=True):
            own = Counter(zip(ws, ws[1:], strict=False)) if i else Counter()
            own_heads, own_seconds = Counter(ws[:-1]) if i else Counter(), Counter(ws[1:]) if i else Counter()
            total = sum(pairs.values()) - sum(own.values()) + size * lm_scoring.FLOOR
            each = [
                -math.log((pairs[a, b] - own[a, b] + lm_scoring.PRIOR * (seconds[b] - own_seconds[b] + lm_scoring.FLOOR) / total) / (heads[a] - own_heads[a] + lm_scoring.PRIOR))
                for a, b in zip(ws, ws[1:], strict=False)
            ]
            means[model, d, len(ws) - 1] = sum(each) / len(each) if each else None
    assert len(got) == len(rows)
    for r in got:
        for model in ("background", "target"):
            mean = means[model, r["doc_id"], r["n_tokens"]]
            assert r[f"{model}_loss"] == (None if mean is None else pytest.approx(mean, rel=1e-5))
    by = {r["doc_id"]: r for r in got}
    # 300 is in the target, where 301 finds it; 300 does not find itself.
    assert by[301]["target_loss"] < by[300]["target_loss"]


def test_halves_of_one_class_are_not_told_apart(spark):
    pick = random.Random(4)
    words = {c: [f"{c}{i}" for i in range(60)] + [f"all{i}" for i in range(60)] for c in "xy"}
    rows = [(i, " ".join(pick.choice(words["x" if i < 400 else "y"]) for _ in range(pick.randint(20, 200)))) for i in range(600)]
    chosen = pick.sample(range(400), 200)
    got = lm_scoring.scored(documents(spark, rows), spark.createDataFrame([(d,) for d in chosen], "doc_id long")).collect()
    score = {r["doc_id"]: r["difference"] for r in got}

    def auc(low, high):
        return sum((score[a] < score[b]) + 0.5 * (score[a] == score[b]) for a in low for b in high) / len(low) / len(high)

    others = [d for d in range(400) if d not in set(chosen)]
    assert 0.45 <= auc(chosen, others) <= 0.55
    assert auc(range(400), range(400, 600)) > 0.95


@pytest.mark.parametrize("bits", [64, 1 << 12, lm_scoring.FILTER_BITS])
def test_a_full_filter_only_moves_more_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(lm_scoring, "FILTER_BITS", bits)
    rows = [(i, f"t{i}") for i in range(-50, 400)] + [(None, "n"), (3, "again")]
    target = spark.createDataFrame([(i,) for i in range(-50, 400, 3)] + [(None,), (9999,), (4,)], "doc_id long")
    def settled(docs, target):
        frame, words = lm_scoring.marked(docs, target)
        return frame.mapInArrow(lambda batches: lm_scoring.settled(batches, words.value), "doc_id long, text string, chosen boolean")

    monkeypatch.setattr(lm_scoring, "TEXT_AT_ONCE", 50)
    got = settled(documents(spark, rows, extra=True), target)
    assert Counter(map(tuple, got.collect())) == Counter((d, t, d is not None and ((d + 50) % 3 == 0 or d == 4)) for d, t in rows)
    assert settled(documents(spark, rows), target.limit(0)).where("chosen").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/x">Home</a></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice"><p>We use cookies, accept, please.</p></div>
<article><h1>Head&nbsp;line</h1><p><b>First &lt;b&gt;
  paragraph, with text.<br><p>Second one &mdash; longer, and longer, still.</p><ul><li>item a<li>item b</ul>
<table><tr><td>c1<td>c2</table><form><input><p>Sign up!</p></form><section class="comments"><p>Nice, very nice, I like it, truly.</p></section></article>
<aside>Related, things, here.</aside><div id="sidebar"><p>More, and more, text.</p></div><footer>&copy; 2020</footer></body></html>"""


def test_extraction_of_an_article():
    assert html_extract.main_text(PAGE) == "\n".join(
        ["Head line", "First <b> paragraph, with text.", "Second one — longer, and longer, still.", "item a", "item b", "c1", "c2"]
    )


def test_extraction_without_an_article():
    page = """<body><div class=menu><a>Home</a> <a>News</a></div><div class=w><div class=post><h2>Title</h2><p>A long paragraph, with commas, and so on.</p>
<blockquote>Quoted, text, here it is.</blockquote><p>Another one, that is long enough, too.</p></div><div><a href=1>link one</a> <a href=2>link two</a></div></div>"""
    assert html_extract.main_text(page).split("\n") == [
        "Title", "A long paragraph, with commas, and so on.", "Quoted, text, here it is.", "Another one, that is long enough, too."
    ]


PARAGRAPHS = [f"Paragraph {i} of the article, which is of ordinary length, and has marks." for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
AROUND = '<div class="menu"><p>Home, news, sport, and more of the menu.</p></div>{}<div class="footer"><p>Imprint, terms, and so on.</p></div>'


@pytest.mark.parametrize(
    "wrap",
    [f'<div class="{c}">{{}}</div>' for c in ("layout has-sidebar", "with-navigation", "right-sidebar", "no-comments", "sidebar")]
    + ["<form action=x>{}</form>", '<div id="widget"><div>{}</div></div>'],
)
@pytest.mark.parametrize("inside", ["<article>{}</article>", "<main><div>{}</div></main>", "<div>{}</div>"])
def test_a_wrapper_s_name_does_not_decide_for_the_article(wrap, inside):
    page = f"<body>{AROUND.format(wrap.format(inside.format(BODY)))}</body>"
    assert html_extract.main_text(page).split("\n") == PARAGRAPHS


@pytest.mark.parametrize("part", ['<section class="related-work">{}</section>', '<div id="legal">{}</div>', '<div class="notice-period">{}</div>'])
def test_parts_of_an_article_with_ambiguous_names_stay(part):
    page = f"<article><div>{BODY}</div>{part.format('<h2>Part</h2><p>This part, too, belongs to the article, and is not short.</p>')}</article>"
    assert html_extract.main_text(page).split("\n") == [*PARAGRAPHS, "Part", "This part, too, belongs to the article, and is not short."]


LAST = ["The last section, which is short, ends it."]
SHORT = ["Short, but text, yes it is."] * 8
VERY_LONG = ["A very long one, that goes on and on, to the end. " * 200]


@pytest.mark.parametrize(
    "parts",
    [(PARAGRAPHS * 4, LAST), ([" ".join(PARAGRAPHS)] * 3, SHORT), (VERY_LONG, PARAGRAPHS), (PARAGRAPHS, VERY_LONG, SHORT), (SHORT, PARAGRAPHS, LAST)],
    ids=["last section", "short paragraphs", "after a long one", "on both sides", "three parts"],
)
def test_an_article_over_sibling_containers_is_whole(parts):
    inner = "".join(f"<div class=p{i}>{''.join(f'<p>{p}</p>' for p in part)}</div>" for i, part in enumerate(parts))
    page = f"<body><div><a href=1>a link</a> <a href=2>and another</a></div><div class=w>{inner}</div></body>"
    assert html_extract.main_text(page).split("\n") == [" ".join(p.split()) for part in parts for p in part]


MENU = "<div><ul>" + "".join(f'<li><a href="/{i}">Menu entry {i}</a></li>' for i in range(30)) + "</ul></div>"


@pytest.mark.parametrize(
    "page",
    [
        "<body>{menu}{body}</body>",
        '<body><div class="page">{menu}{body}</div></body>',
        "<body><div><div>{first}</div>{menu}<div>{rest}</div></div></body>",
        "<body><article>{first}{menu}{rest}</article></body>",
        "<body><div>{menu}</div><div><article>{body}</article></div></body>",
    ],
    ids=["beside the paragraphs", "in a page wrapper", "between containers", "in the article", "before the article"],
)
def test_unnamed_menus_go(page):
    cut = BODY.index("</p>") + 4
    assert html_extract.main_text(page.format(menu=MENU, body=BODY, first=BODY[:cut], rest=BODY[cut:])).split("\n") == PARAGRAPHS


COMMENTS = "".join(f"<div><p>Comment {i}: I like it, very much, and I have quite a lot to say about that, as ever, in my own words.</p></div>" for i in range(40))
ARTICLES = "".join(f'<article class="comment"><p>Comment {i}: well, well, I like it, very much, and say so.</p></article>' for i in range(40))


@pytest.mark.parametrize("inner", [COMMENTS, ARTICLES], ids=["divs", "articles"])
@pytest.mark.parametrize(
    "part",
    ['<div class="comments">{}</div>', '<section id="reader-comments">{}</section>', '<div id="respond">{}</div>', '<div class="post-comments list">{}</div>', "<footer>{}</footer>", "<nav>{}</nav>", "<aside>{}</aside>"],
)
@pytest.mark.parametrize(
    "page", ["<article>{body}</article>{part}", "<article>{body}{part}</article>", "<div class=w><div>{body}</div>{part}</div>", "<main><article>{body}</article>{part}</main>"]
)
def test_comments_and_footers_longer_than_the_article_go(inner, part, page):
    assert html_extract.main_text(f"<body>{page.format(body=BODY, part=part.format(inner))}</body>").split("\n") == PARAGRAPHS


@pytest.mark.parametrize(
    "part",
    [
        '<div class="notice"><p>We use cookies, and so on, for all kinds of purposes, as you know.</p></div>',
        '<div class="alert">This site is in maintenance, on Sunday, from two to four, sorry.</div>',
        '<div><a href="/buy">Buy our new product, now, at half the price!</a></div>',
        '<p><a href="/buy">Buy our new product, now!</a></p>',
        '<form><p>Sign up, now, for our letter, and read it every day.</p></form>',
    ],
)
@pytest.mark.parametrize("page", ["<article>{first}{part}{rest}</article>", "<div>{part}</div><article>{first}{rest}</article>", "<div class=w>{first}{rest}{part}</div>"])
def test_notices_adverts_and_forms_go(part, page):
    cut = BODY.index("</p>") + 4
    assert html_extract.main_text(f"<body>{page.format(first=BODY[:cut], rest=BODY[cut:], part=part)}</body>").split("\n") == PARAGRAPHS


def test_lists_tables_and_short_blocks_of_the_article_stay():
    inner = BODY + "<h2>Parts</h2><ul><li>one</li><li>two <a href=x>linked</a> words here</li></ul><table><tr><td>a</td><td>b</td></tr></table><p>Ok.</p>"
    wanted = [*PARAGRAPHS, "Parts", "one", "two linked words here", "a", "b", "Ok."]
    for page in (f"<article>{inner}</article>", f"<div class=w>{MENU}<div>{inner}</div></div>"):
        assert html_extract.main_text(f"<body>{page}</body>").split("\n") == wanted


@pytest.mark.parametrize("depth", [600, 5000])
def test_depth_is_no_limit(depth):
    deep = "<div>" * depth + '<nav><p>Home, news, sport, and the rest, of a menu that is deep down.</p></nav><div class="comments"><p>I say, too, something.</p></div>'
    assert html_extract.main_text(f"<body>{deep}{BODY}</body>").split("\n") == PARAGRAPHS
    assert html_extract.main_text("<div>x" * 30_000).count("x") == 30_000


def test_path_ratios_against_a_parsed_tree():
    pick = random.Random(3)

    def block(depth):
        tag = pick.choice(["div", "section", "ul", "blockquote"])
        name = pick.choice(["", "", ' class="a b"', ' id="c"'])
        inner = "".join(block(depth - 1) if depth and pick.random() < 0.5 else f"<p>{' '.join(pick.choice(['word', 'and,', 'so.', '<a href=x>link</a>']) for _ in range(pick.randint(1, 12)))}</p>" for _ in range(pick.randint(1, 4)))
        return f"<{tag}{name}>{inner}</{tag}>"

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.stack, self.sums, self.anchor = [], {}, 0

        def handle_starttag(self, tag, attrs):
            self.anchor += tag == "a"
            if tag != "a":
                self.stack.append(".".join([tag, *sorted(w for _, v in attrs for w in v.split())]))
                if tag == "p":
                    self.text, self.linked = "", 0

        def handle_data(self, data):
            self.text, self.linked = self.text + data, self.linked + len(data) * bool(self.anchor)

        def handle_endtag(self, tag):
            self.anchor -= tag == "a"
            if tag == "p":
                self.sums.setdefault("/".join(self.stack), []).append((len(self.text) - self.linked, self.text.count(",") + self.text.count(".") + 1))
            if tag != "a":
                self.stack.pop()

    for _ in range(60):
        page = block(3)
        tree = Tree()
        tree.feed(page)
        whole = html_extract.read(page)
        own = np.array([len(leaf.text) - leaf.linked for leaf in whole.leaves], dtype=float)
        marks = np.array([leaf.text.count(",") + leaf.text.count(".") for leaf in whole.leaves], dtype=float)
        path, text, punctuation = html_extract.path_ratios(whole.leaves, own, marks)
        got = {(p, round(a, 9), round(b, 9)) for p, a, b in zip(path.tolist(), text.tolist(), punctuation.tolist(), strict=True)}
        wanted = [tuple(round(sum(x) / len(x), 9) for x in zip(*rows, strict=True)) for rows in tree.sums.values()]
        assert sorted(g[1:] for g in got) == sorted(wanted) and len(got) == len(tree.sums)


@pytest.mark.parametrize("page", [None, "", "<", "<a", "&", "<!--", "<script>a", "<div " * 3000, "<div>" * 30_000 + "x", '<a "' * 3000, "</p>" * 3000])
def test_extraction_of_broken_pages(page):
    assert html_extract.main_text(page) in ("", "<", "&", "x", '<a "' * 3000) or page.startswith("<a")


def test_extraction_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "plain words"), (3, "w", "<p>" + "long text, " * 50_000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = html_extract.extracted(frame).collect()
    assert Counter((r["page_id"], r["url"], r["n_chars"] == len(r["text"])) for r in got) == Counter((a, b, True) for a, b, _ in rows)
    assert {r["page_id"]: r["text"] for r in got}[2] == "" and {r["page_id"]: r["text"] for r in got}[None] == "plain words"
    assert html_extract.extracted(frame.limit(0)).count() == 0
