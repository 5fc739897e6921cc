"""The numpy and text parts of the corpus operators, against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from refloom.llm import common, decontaminate, extraction, fingerprints, langid, language_model, neardup, packing, secrets, token_counts, toxicity

rng = random.Random(5)


def some_text(alphabet="abc de.\n\té ", least=0, most=80):
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(least, most)))


def plain_shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


# -- common


def test_blocks_do_not_change_words(monkeypatch):
    texts = [some_text() for _ in range(50)]
    whole = [common.word_hashes(t).tolist() for t in texts]
    monkeypatch.setattr(common, "blocks", lambda data, size=3, f=common.blocks: f(data, 3))
    assert [common.word_hashes(t).tolist() for t in texts] == whole


def test_shingle_sets():
    for t in [None, "", " \n", "one", "A b", *[some_text() for _ in range(200)]]:
        assert len(common.shingle_set(t, 3)) == len(plain_shingles(t, 3))
    assert common.shingle_set("A b C d", 3).tolist() == common.shingle_set("a  B\nc D", 3).tolist()


# -- language identification


def test_grams(monkeypatch):
    def plain(t):
        t = re.sub(" +", " ", " " + re.sub(r"[\W\d_]+", " ", t.lower()).strip() + " ")
        if not t.strip():
            return set()
        return {sum(ord(c) << (21 * (n - 1 - k)) for k, c in enumerate(t[i : i + n])) for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    texts = [some_text("abé 1.  ßЖ\n", 0, 30) for _ in range(300)]
    for size in (1 << 20, 7, 2):
        monkeypatch.setattr(langid, "STRETCH", size)
        assert all(set(langid.grams(t).tolist()) == plain(t) for t in texts)
    assert len(langid.grams(None)) == 0 and len(langid.grams("123 ...")) == 0


def test_weights_are_the_kernel_solution():
    rows = [("x", some_text("abc ", 20, 60)) for _ in range(20)] + [("y", some_text("cde ", 20, 60)) for _ in range(20)]
    model = langid.Model.fit(rows, landmarks=20)
    # All rows are landmarks: the map is exact, so ridge regression on plain kernel features must agree.
    sets = [set(langid.grams(t).tolist()) for _, t in rows]
    k = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    values, vectors = np.linalg.eigh(k)
    keep = values > 1e-6 * values[-1]
    f = np.c_[k @ (vectors[:, keep] / np.sqrt(values[keep])), np.ones(len(rows))]
    y = np.array([[1.0, -1.0] if lang == "x" else [-1.0, 1.0] for lang, _ in rows])
    w = np.linalg.solve(f.T @ f / 20 + langid.RIDGE / 2 * np.eye(f.shape[1]), f.T @ y / 20)
    got = langid.presence([langid.grams(t) for _, t in rows], model.known) @ model.weights + model.constant
    assert np.abs(got - f @ w).max() < 1e-2
    best, share = model.score([langid.grams(t) for _, t in rows])
    assert [model.langs[b] for b in best] == [lang for lang, _ in rows] and (share > 0.5).all()


# -- token counts


@pytest.mark.parametrize("leaf", [4, 64])
def test_edits_keep_the_count(monkeypatch, leaf):
    monkeypatch.setattr(token_counts, "LEAF", leaf)
    c = token_counts.counter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for _ in range(600):
        text = some_text("ab  's\n1!ll é", 0, 90)
        tree = token_counts.Tree.of(text, c)
        for _ in range(5):
            insert = "".join(rng.choice(["a", "l", "'", "s", " ", "\n", "1", "!", "'ve"]) for _ in range(rng.choice([0, 1, 4, 40])))
            text, _ = tree.edit(text, (rng.randint(0, len(text) + 2), rng.choice([0, 1, 3, 50]), insert), c)
            assert tree.n_tokens == c.whole(text) and tree.chars[1] == len(text)
            assert np.concatenate(tree.lengths).tolist() == [len(x) for x in c.pattern.findall(text)]
            tree = token_counts.Tree.from_bytes(tree.to_bytes())


def test_edit_encodes_little():
    c = token_counts.counter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = "some words and more of them " * 5000
    tree = token_counts.Tree.of(text, c)
    after, encoded = tree.edit(text, (70_000, 4, "other"), c)
    assert encoded < 10 and tree.n_tokens == c.whole(after)


# -- packing


def test_tokenizer_paths_agree():
    t = packing.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    hard = [
        "", "  ", "It's I'M we'LL x's", "naïve İstanbul ΣΑΣ", "a\x00b", "foo<|endoftext|>bar", "\xa0a\xa0b\x85c", "日本語 テスト", "1234 ½ ²x",
        "“quoted” – dash… €5", "a\x1cb", "é combining", "__x_y ''s",
    ]
    for text in hard + [some_text("ab'sre .,_1éß\n", 0, 60) for _ in range(300)]:
        ids = t.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(t.encode(text), "<u4").tolist() == ids, text


def test_best_fit():
    for _ in range(200):
        sizes = sorted((rng.randint(1, 20) for _ in range(rng.randint(0, 40))), reverse=True)
        free = []
        for s in sizes:
            fits = [f for f in free if f >= s]
            if fits:
                free[free.index(min(fits))] -= s
            else:
                free.append(20 - s)
        got = packing.best_fit(np.array(sizes, int), 20)
        fill = np.bincount(got, sizes, max(got, default=-1) + 1) if len(sizes) else np.empty(0)
        assert sorted(fill.tolist()) == sorted(20.0 - f for f in free)


def test_cut():
    data = np.arange(10, dtype="<u4").tobytes()
    assert [(p, s, n) for p, s, n, _ in packing.cut(data, 4)] == [(0, 0, 4), (1, 4, 4), (2, 8, 2)]
    assert next(packing.cut(data, 4))[3] == zlib.crc32(data[:16])


# -- toxicity


def test_gradients():
    net = toxicity.Network({b"ab": 1, b"cd": 2}, np.ones(toxicity.BUCKETS, bool))
    r = np.random.default_rng(0)
    for k in net.p:
        net.p[k] = net.p[k].astype(float) + 0.3 * r.standard_normal(net.p[k].shape)
    words, at, y = [b"ab", b"cd", b"hello", b"x"], r.integers(0, 5, (3, toxicity.LENGTH)), np.array([1, 0, 1.0])
    at[:, -5:] = 0

    def loss():
        x = np.concatenate([np.zeros((1, toxicity.SIZE)), net.inputs(words)[0]])
        logit = net.run(net.tables(x), at)
        return np.mean(np.logaddexp(0, logit) - y * logit)

    g = net.gradients(words, at, y)
    for k, p in net.p.items():
        i = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old, step = p[i], 1e-2
        p[i] = old + step
        up = loss()
        p[i] = old - step
        slope = (up - loss()) / (2 * step)
        p[i] = old
        assert abs(slope - g[k][i]) < 1e-3 * max(0.05, abs(slope)), k


def test_windows_cover_all_words():
    for n in [0, 1, 15, 16, 17, 28, 29, 100, 101]:
        w = toxicity.window_rows(np.arange(1, n + 1))
        assert set(w.ravel().tolist()) - {0} == set(range(1, n + 1)) and w.shape[1] == toxicity.LENGTH
    assert toxicity.words_of("x" * 60 + " Y!") == [b"x" * 24, b"x" * 24, b"x" * 12, b"y"]


def test_network_learns_words_and_their_parts():
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]

    def text(bad):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))]
        if bad:
            w.insert(rng.randrange(len(w)), rng.choice(["zonk", "zonkish", "zonker", "zonkly"]))
        return " ".join(w)

    rows = [(text(k % 3 == 0), int(k % 3 == 0)) for k in range(300)]
    scorer = toxicity.Scorer(toxicity.fit(rows))
    held = [(text(k % 2), k % 2) for k in range(100)]
    right = (scorer.probability([t for t, _ in held]) >= toxicity.THRESHOLD) == np.array([y for _, y in held], bool)
    assert right.mean() > 0.95
    # A word form that no learning text has, at the very end of a long text.
    assert scorer.probability([" ".join(rng.choice(vocabulary) for _ in range(3000)) + " zonkable"])[0] >= toxicity.THRESHOLD
    assert toxicity.fit([("a", 1)]) is None and toxicity.fit([]) is None
    assert 0 <= scorer.probability([None, ""])[0] <= 1


# -- language model


def test_probabilities_sum_to_one():
    frequent = [(int(language_model.END), 50)] + [((k << 6) | 3, 40 - k) for k in range(1, 30)]
    model = language_model.Model(frequent, {3: (20, 7), 5: (9, 4)})
    r = np.random.default_rng(1)
    model.outer += r.standard_normal(model.outer.shape).astype(np.float32)
    model.inner += r.standard_normal(model.inner.shape).astype(np.float32)
    # One symbol after the same two: every frequent token, and the rare ones with unknown words by class.
    total = 0.0
    for s in range(len(frequent)):
        total += math.exp(model.log_probability(np.array([1, 2, s]), np.ones(3), np.array([3]))[2])
    for shape in range(language_model.SHAPES):
        words, tokens = {3: (7, 20), 5: (4, 9)}.get(shape, (0, 0))
        counts = [tokens / max(1, words)] * words + [0]
        for c in counts:
            got = model.log_probability(np.array([1, 2, language_model.FREQUENT + shape]), np.array([1, 1, c]), np.array([3]))[2]
            total += math.exp(got)
    assert abs(total - 1) < 1e-3


def test_steps_lower_the_loss():
    model = language_model.Model([((k << 6) | 1, 10) for k in range(1, 64)], {1: (10, 5)})
    symbols, lengths = np.tile(np.arange(20), 200), np.full(200, 20)
    before = model.log_probability(symbols, np.ones(4000), lengths).mean()
    seen = np.zeros_like(model.outer), np.zeros_like(model.inner)
    for _ in range(10):
        model.learn(symbols, lengths, seen)
    assert model.log_probability(symbols, np.ones(4000), lengths).mean() > before + 1


def test_block_numbers_round_trip():
    texts = [language_model.token_keys(t) for t in ["b a b", "", "a c"]]
    row = language_model.number_block(1, [1, 2, 3], [True, False, True], texts)
    keys = np.frombuffer(row["keys"], np.uint64)
    assert keys[language_model._unpack(row["tokens"], "<u4")].tolist() == np.concatenate(texts).tolist()
    want = Counter(np.concatenate([texts[0], texts[2]]).tolist())
    assert np.frombuffer(row["counts"], "<u4").tolist() == [want[k] for k in keys.tolist()]


# -- secrets


def plain_base(text):
    any_case = "".join
    words = ["password", "passwd", "secret", "token", "apikey", "api_key"]
    key = "|".join(any_case(f"[{c.upper()}{c}]" if c != "_" else "_" for c in w) for w in words)
    out = [(m.start(), 0, m.end()) for m in re.finditer(rf"""(?:{key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


def test_base_spans():
    parts = ["password", "Token", "api_key", "APIKEY", "ſecret", "=", ": ", '"', "'", "abcd1234", "x", " ", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é", "\n"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s[:3] for s in secrets.base_spans(t)] == plain_base(t), t


def test_masks():
    assert secrets.mask("abcdef", [(1, 3), (2, 4)], "*") == "a*ef"
    assert secrets.mask("abcdef", [(0, 6)], "*") == "*" and secrets.mask("abc", []) == "abc"
    assert secrets.other_spans("x aB3dE5gH7jK9mN1pQ3rS y", [])[0][:3] == (2, 3, 22)
    assert not secrets.other_spans("plainwordplainwordplainword", [])


# -- decontamination


def plain_matches(text, items, n=5):
    words = decontaminate.clean_words(text).tolist()
    out = {}
    for i, item in items:
        w = decontaminate.clean_words(item).tolist()
        if not w or not words:
            continue
        if len(w) < n or len(words) < n:
            if w == words:
                out[i] = 1.0
            continue
        a = Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
        size, best = min(len(w), len(words)), 0.0
        for at in range(len(words) - size + 1):
            b = Counter(tuple(words[at + k : at + k + n]) for k in range(size - n + 1))
            best = max(best, sum((a & b).values()) / sum((a | b).values()))
        if best >= 0.8:
            out[i] = best
    return out


@pytest.mark.parametrize("stretch", [1 << 15, 16])
def test_benchmark_windows(monkeypatch, stretch):
    monkeypatch.setattr(decontaminate, "STRETCH", stretch)
    vocabulary = ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 20, 21, 40])))) for k in range(30)]
    items += [(90, None), (91, " ..."), (92, items[4][1])]
    index = decontaminate.Index(items)
    for _ in range(150):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.8:
            put = rng.choice(items[:30])[1].split()
            if rng.random() < 0.5:
                put[rng.randrange(len(put))] = "zz"
            if rng.random() < 0.3:
                put = put[1:]
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() + rng.choice(["", ",", "!"]) for x in put]
        text = " - ".join([" ".join(w[:30]), " ".join(w[30:])])
        got = index.matches(text)
        assert {m["item_id"]: round(m["similarity"], 9) for m in got} == {k: round(v, 9) for k, v in plain_matches(text, items).items()}
        for m in got:
            assert len(decontaminate.clean_words(text[m["start"] : m["end"]])) == m["n_words"]
    assert index.matches(None) == [] and index.matches("  ") == []


# -- near duplicates


def test_odd_sketches_estimate_similarity():
    for share in (0.5, 0.8, 0.95):
        estimates = []
        for k in range(60):
            r = np.random.default_rng(k)
            common_part = r.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64)
            rest = r.integers(0, 1 << 63, 2 * int(1000 * (1 - share) / 2) + 2, dtype=np.uint64)
            a, b = np.r_[common_part, rest[::2]], np.r_[common_part, rest[1::2]]
            odd = neardup.odd_sketches(np.array([neardup.min_hashes(np.sort(x)) for x in (a, b)]))
            estimates.append(neardup.odd_similarity(np.bitwise_count(odd[0] ^ odd[1]).sum()))
        assert abs(np.mean(estimates) - share) < 0.04
    assert neardup.odd_limit(85) < neardup.odd_limit(80) < neardup.ODD_BITS // 2


# -- fingerprints


def test_sketches():
    for _ in range(60):
        a, b = some_text("ab ", 0, 4000), some_text("ab ", 0, 4000)
        s, t = fingerprints.sketch(a, 2), fingerprints.sketch(b, 2)
        every = common.unique(np.r_[*[common.shingle_hashes(common.word_hashes(x), 2) >> np.uint64(16) for x in (a, b)]])
        assert fingerprints.merge([s, t]).tolist() == every[:64].tolist()
        assert fingerprints.from_text(fingerprints.to_text(s)).tolist() == s.tolist()
    words = [f"w{k}" for k in range(6000)]
    a, b = " ".join(words[:4000]), " ".join(words[2000:6000])
    s, t = fingerprints.sketch(a), fingerprints.sketch(b)
    assert abs(fingerprints.distinct(s) - 3996) < 1500
    assert abs(fingerprints.resemblance(s, t) - 1 / 3) < 0.2 and abs(fingerprints.containment(s, t) - 0.5) < 0.3
    empty = fingerprints.sketch(None)
    assert fingerprints.resemblance(empty, empty) == 1 and fingerprints.resemblance(empty, s) == 0
    assert fingerprints.edit("abcdefgh", "X") == "abcdefX" and fingerprints.edit("abc", "x") == "abc"


# -- page text

PAGE = """<html><head><title>no</title></head><body class="has-sidebar"><header><a href=/>Site</a><p>A tag line of the site</p></header>
<nav><ul><li>Home<li>News</ul></nav><div id="cookie-notice">We use cookies &amp; such.</div><div class="wrapper"><div class="content-main">
<h1>Big &eacute;v&eacute;nement</h1><p>First   paragraph of the story that is quite long&nbsp;and full of text, really.</p><p>Short.</p>
<div class="ad">Buy now a lot of things, very cheap, buy buy buy them all now</div><ul><li>one item<li>two item</ul><blockquote>quote here</blockquote>
<p>Last paragraph, which is also long, with <a href=x>a link</a> and <b>bold</b> text.</p></div>
<div class="sidebar"><p>Some related teaser text that is long enough to be taken for content by mistake.</p></div>
<section class="comments"><h3>Comments</h3><p>I disagree with this article very much, and write a long comment on it here.</p></section></div>
<form><input><label>mail</label></form><footer>&copy; 2020</footer><script>var x="<p>no</p>"</script></body></html>"""
TEXT = """Big événement
First paragraph of the story that is quite long and full of text, really.
Short.
one item
two item
quote here
Last paragraph, which is also long, with a link and bold text."""


def test_page_text():
    assert extraction.content(PAGE) == TEXT
    assert extraction.content("<body><nav>menu</nav><article><h1>T</h1><p><b>One<br><p>two &lt;3</article><footer>f</footer>") == "T\nOne\ntwo <3"
    assert extraction.content(None) == extraction.content("") == extraction.content("<nav>menu</nav>") == ""
    assert extraction.content("no mark-up at all") == "no mark-up at all"
    assert extraction.content("</div></p><p>a</b></article>b<p") .startswith("a")
    for _ in range(200):
        soup = "".join(rng.choice(["<p>", "</p>", "<div>", "</div>", "<nav>", "</nav>", "text ", "<", ">", "&amp;", "<!--", "-->", "<script>"]) for _ in range(30))
        extraction.content(soup)


LONG = "A paragraph of the story that is long enough to be taken for text by its ratio, and then some more words of it."
LINKS = "<div>" + "".join(f"<span><b><a href=x>l{k}</a></b></span><br>" for k in range(8)) + "</div>"


def test_clusters_select_regions():
    """The smoothed ratios decide, with article elements and without: all parts with text stay, link lists go."""
    story = "".join(f"<p>{k} {LONG}</p>" for k in range(5))
    text = "\n".join(f"{k} {LONG}" for k in range(5))
    lead = "A lead of one sentence that stands apart from the body of the story, as it often does."
    # No article element, lead and title in siblings with less than a fifth of the text, the rest split in two.
    split = f"<body>{LINKS}<div><h1>Title</h1></div><div><p>{lead}</p></div><div>{story}</div><div>{story}</div>{LINKS}</body>"
    assert extraction.content(split) == "\n".join(["Title", lead, text, text])
    # Two article elements of different size, with and without one around them.
    for a, b in (("<main>", "</main>"), ("", "")):
        two = f"<body>{LINKS}{a}<article><h2>One</h2>{story}</article><article><h2>Two</h2><p>{LONG}</p></article>{b}{LINKS}</body>"
        assert extraction.content(two) == "\n".join(["One", text, "Two", LONG])
    # An article element without clustered text is no content; the text stands elsewhere.
    card = f"<body><article>{LINKS}</article><div>{story}</div></body>"
    assert extraction.content(card) == text
    # A body part after the article element, and a short list inside it.
    after = f"<body><article>{story}<ul>{'<li><b><i>x</i></b>' * 9}</ul></article><div>{story}</div><div>{LINKS}</div></body>"
    assert extraction.content(after) == "\n".join([text, *"x" * 9, text])


@pytest.mark.parametrize("tag", ["article", "div"])
def test_names_of_sections(tag):
    """Sections, headings and paragraphs with doubtful names stay inside the content; link lists, notices and adverts by these names go."""
    story = "".join(f"<p>{k} {LONG}</p>" for k in range(4))
    links = '<section class="related"><ul>' + "<li><a href=x>Another story</a>" * 5 + "</ul></section>"
    page = (
        f'<{tag}>{story}<section id="discussion"><h2 id="legal">Law</h2><p id="search">{LONG}</p></section><section id="related-work"><p>{LONG}</p>'
        f'</section><div class="cookie-notice">{LONG}</div><div class="ad">{LONG}</div>{links}{story}</{tag}><div class="related"><p>{LONG}</p></div>'
    )
    text = "\n".join(f"{k} {LONG}" for k in range(4))
    assert extraction.content(page) == "\n".join([text, "Law", LONG, LONG, text])


def test_smoothing_keeps_level_lines():
    assert np.allclose(extraction.smooth(np.full(7, 3.0)), 3.0) and len(extraction.smooth(np.ones(1))) == 1


@pytest.mark.parametrize("part", [
    '<section class="cookie-recipes"><h2>Ginger</h2><p>{}</p></section>', '<div class="section-header"><h2>Ginger</h2></div><p>{}</p>',
    '<h2>Ginger</h2><div id="rail"><p>{}</p></div>', '<h2>Ginger</h2><div class="banner">{}</div>', '<h2>Ginger</h2><p class="menu">{}</p>',
])
def test_names_alone_drop_nothing_of_an_article(part):
    text = " ".join(["Some plain words that go on for a while, as an article does."] * 4)
    page = f"<body><nav><a>Home</a></nav><article><h1>Title</h1><p>{text}</p>{part.format(text)}<p>{text}</p></article><footer>Legal</footer></body>"
    assert extraction.content(page) == "\n".join(["Title", text, "Ginger", text, text])


@pytest.mark.parametrize("part", [
    '<div class="ad">{}</div>', '<aside class="sidebar">{}</aside>', '<div class="comments"><p>{}</p></div>', '<div class="newsletter-box">{}</div>',
    '<div class="menu"><ul><li><a>One</a><li><a>Two</a></ul></div>', '<div class="site-header"><a>Home page of this site</a></div>',
])
def test_furniture_in_an_article(part):
    text = " ".join(["Some plain words that go on for a while, as an article does."] * 4)
    page = f"<body><article><h1>Title</h1><p>{text}</p>{part.format(text)}<p>{text}</p></article></body>"
    assert extraction.content(page) == "\n".join(["Title", text, text])
