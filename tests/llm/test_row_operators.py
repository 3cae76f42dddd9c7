"""HTML extraction, quality rules, toxicity, URL filters, chat formatting."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millsight.llm import chat_format, html_extract, quality_rules, toxicity, url_filter
from millsight.llm.queries import QUERIES

PAGE = """<html><body class="no-sidebar"><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies, accept all of them please now</div><div id="wrap">
<div class="post-content"><h2>Ti&eacute;tle</h2><p>One <b>bold</b> para a &lt; b with <a href=x>link</a>
and enough text to count as content.<p>Second<br>line here&nbsp;too, long enough to be a paragraph.
<ul><li>item one<li>item two</ul><div class="share-buttons">Share me</div>
<form><p>Sign up for this form now please</p></form><p hidden>unseen text</p></div>
<section id="comments"><p>Great article! I really loved reading it, and this comment is longer than the
article was, indeed much longer than it was, and so on and on.</p></section></div>
<div class="sidebar"><p>side text which is quite long as well, really.</p></div><script>var a="</p>"</script>
</body></html>"""


def test_extraction_keeps_the_article_only():
    text, path = html_extract.extract(PAGE, None)
    assert text.split("\n") == [
        "Tiétle",
        "One bold para a < b with link and enough text to count as content.",
        "Second line here too, long enough to be a paragraph.",
        "item one",
        "item two",
    ]
    assert path.endswith("div.post-content")


@pytest.mark.parametrize(
    "html, text", [(None, ""), ("", ""), ("a &amp; b", "a & b"), ("<script>x<p>y", ""), ("<p>s", "s")]
)
def test_extraction_of_odd_pages(html, text):
    assert html_extract.extract(html, "nowhere")[0] == text


@pytest.mark.parametrize("quote, other", ['"\'', '\'"'])
def test_long_attributes_are_no_text(quote, other):
    value = f"{{a: 1 > 0}} <div class={other}nav{other}><p>markup inside a value > that is no text</p> " * 200
    html = f"<body><div class=post data-x={quote}{value}{quote}><p>{'real words of it ' * 5}</p></div></body>"
    assert html_extract.extract(html, None)[0] == ("real words of it " * 5).strip()
    stray = f"<body><p title=it's{other} {quote}>first words</p><p id={quote}never closed>second words</p>"
    assert html_extract.extract(stray, None)[0] == "first words\nsecond words"


def test_host_consensus_overrules_one_page(spark, frame):
    body = "<p>%s</p>" % ("plain words of an article, quite a few of them, " * 4)
    common = f"<body><div class=box>{body}</div><div class=extra><p>short aside here, not long</p></div>"
    odd = f"<body><div class=box>{body}</div><div class=extra>{body}<p>and some more of it</p></div>"
    rows = [(i, f"http://h.org/{i}", common) for i in range(5)] + [(9, "http://h.org/9", odd)]
    rows += [(10, None, None), (10, "nothing", ""), (11, "http://solo.org", odd)]
    pages = frame("page_id int, url string, html string", *rows)
    found = {r.page_id: r for r in html_extract.main_text(pages, ("page_id",)).collect()}
    assert found[9].path.endswith("div.box") and "some more" not in found[9].text
    assert "some more" in found[11].text
    assert found[10].text == "" and len(found) == 8


PLAIN = "<p>%s plain words of an article, quite a few of them, and then some more of these.</p>"


def paragraphs(name: str, n: int) -> str:
    return "".join(PLAIN % f"{name} {i}" for i in range(n))


def lines_of(name: str, n: int) -> list[str]:
    return [re.sub("<[^>]*>", "", PLAIN % f"{name} {i}") for i in range(n)]


@pytest.mark.parametrize("wrap", ("%s", "<div class=page>%s</div>"))
def test_siblings_of_article_text_stay_together(wrap):
    """A lead and a story are both the article, whichever host's winner is only one of them."""
    html = "<body>" + wrap % f"<div class=lead>{paragraphs('lead', 3)}</div><div class=story>{paragraphs('story', 7)}</div>"
    for winner in (None, ">html>body>div.other", ">body>div.lead", ">body>div.page>div.lead"):
        text, _ = html_extract.extract(html, winner)
        assert text.split("\n") == lines_of("lead", 3) + lines_of("story", 7)


def test_a_headline_beside_the_body_belongs_to_it():
    html = f"<body><div class=top><h1>The headline</h1></div><div class=body>{paragraphs('body', 4)}</div><div class=x><p>tiny</p>"
    assert html_extract.extract(html, None)[0].split("\n") == ["The headline", *lines_of("body", 4)]
    own = f"<body><h1>Site name</h1><div class=body><h1>The headline</h1>{paragraphs('body', 4)}</div>"
    assert html_extract.extract(own, None)[0].split("\n") == ["The headline", *lines_of("body", 4)]


@pytest.mark.parametrize(
    "opening, closing",
    [("<form id=aspnetForm>", "</form>"), ("<div class=shared-layout>", "</div>"), ("<div class=social-page>", "</div>"),
     ("<div class=shareholder-letter>", "</div>"), ("<div class='promo promo-page'>", "</div>"), ("<div id=related>", "</div>")],
)
def test_wrappers_of_the_page_are_not_dropped(opening, closing):
    inner = f"<nav><a href=x>menu menu menu</a></nav><div class=body>{paragraphs('body', 4)}</div><div class=share-bar>Share me</div>"
    assert html_extract.extract(f"<body>{opening}{inner}{closing}</body>", None)[0].split("\n") == lines_of("body", 4)


@pytest.mark.parametrize("junk", ("<form>%s</form>", "<div class=social>%s</div>", "<div class=comments>%s</div>", "<aside>%s</aside>"))
def test_named_elements_beside_the_article_are_dropped(junk):
    """Also where they hold most of the text; comments and asides even if little stands beside them."""
    for n in (1, 30):
        html = f"<body><div class=body>{paragraphs('body', 6)}</div>{junk % paragraphs('junk', n)}</body>"
        assert html_extract.extract(html, None)[0].split("\n") == lines_of("body", 6)


def test_votes_are_per_host_and_template(spark, frame):
    """No page has an article element. One host, two templates; the vote decides on odd pages of each."""
    teaser, more = "<div class=teasers>%s</div>", "<div class=teasers><p>short teaser, not very long</p></div>"
    news = "<body><div class=text>" + paragraphs("news", 3) + "</div>%s</body>"
    shop = "<body><div class=offer>" + paragraphs("offer", 4) + "</div></body>"
    rows = [(i, f"https://h.org/{i}", news % more) for i in range(4)]
    rows += [(4, "https://h.org/4", news % (teaser % paragraphs("teaser", 3)))]
    rows += [(i, f"https://h.org/shop/{i}", shop) for i in range(5, 9)]
    rows += [(9, "https://other.org/1", news % (teaser % paragraphs("teaser", 3)))]
    pages = frame("page_id int, url string, html string", *rows)
    found = {r.page_id: r.text.split("\n") for r in html_extract.main_text(pages, ("page_id",)).collect()}
    for page in range(5):
        assert found[page] == lines_of("news", 3)
    for page in range(5, 9):
        assert found[page] == lines_of("offer", 4)
    assert found[9] == lines_of("news", 3) + lines_of("teaser", 3)  # nobody to agree with


def test_extraction_of_the_table(spark, folder, rows_of):
    found = {r.page_id: r for r in QUERIES["op1_html_extraction"](spark, folder).collect()}
    for page_id, html in rows_of("pages", "page_id", "html"):
        article = re.search(r"<article>(.*)</article>", html, re.S).group(1)
        blocks = [re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?p>|</?h1>", article)]
        lines = (" ".join(html_extract.entities.unescape(b).split()) for b in blocks)
        assert found[page_id].text == "\n".join(filter(None, lines))
        assert found[page_id].n_chars == len(found[page_id].text)


def slow_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered |= {i, i + 1, i + 2}
    return len(covered)


def test_estimated_accuracies_decide_over_single_votes(frame):
    """Texts with one bad vote of a rule that errs on good texts stay; all-must-pass would drop them."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdeilmnorst"), rng.integers(3, 9))) for _ in range(3000)]
    rows = []
    for i in range(300):
        lines = [" ".join(["the", *rng.choice(words, 9), "and", *rng.choice(words, 4)]) for _ in range(12)]
        if i % 10 == 1:  # junk: marks, digits, no ends
            lines = [" ".join(f"#{w} {rng.integers(10**9)} $$%" for w in rng.choice(words, 6)) for _ in range(12)]
        elif i % 10 != 0:  # a tenth are verse: their lines have no full stop
            lines = [line + "." for line in lines]
        rows.append((i, "\n".join(lines)))
    judged = quality_rules.judge(frame("doc_id long, text string", *rows), ("doc_id",)).collect()
    rules = [f"vote_{name}" for name in quality_rules.rules()]
    passed = {r.doc_id for r in judged if not r.base_failed and all(r[rule] != -1 for rule in rules)}
    kept = {r.doc_id for r in judged if r.kept}
    past_base = {r.doc_id for r in judged if not r.base_failed}
    assert passed < kept < past_base
    differing = kept - passed
    assert differing and differing <= set(range(0, 300, 10))
    assert not kept & set(range(1, 300, 10))


def test_carried_columns_of_own_names_give_way(frame):
    documents = frame("doc_id long, text string, n_words string, _text string", (1, "some words here", "x", "y"))
    row = quality_rules.judge(documents, ("doc_id", "n_words", "_text")).first()
    assert (row.doc_id, row.n_words, row["_text"]) == (1, 3, "y")


def test_base_features_by_brute_force(spark, folder, rows_of):
    found = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, folder).collect()}
    for doc_id, text in rows_of("documents", "doc_id", "text"):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        repeats = slow_repeats(words)
        row = found[doc_id]
        assert (row.n_words, row.word_chars) == (len(words), sum(map(len, words)))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == repeats
        assert row.base_failed == (len(words) < 50 or 100 * repeats > 50 * len(words))
        assert not (row.base_failed and row.kept)


def test_label_model_finds_planted_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    chance = np.array([[0.6, 0.005], [0.5, 0.01], [0.4, 0.015], [0.7, 0.002]])
    bad = rng.random((len(good), 4)) < np.where(good[:, None], chance[:, 1], chance[:, 0])
    votes = np.where(rng.random(bad.shape) < 0.2, 0, np.where(bad, -1, 1))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, fitted = quality_rules.fit(patterns, counts.astype(float), strength=0.001)
    assert abs(prior - 0.8) < 0.05
    assert np.abs(fitted[:, 0] - chance[:, 0]).max() < 0.08
    right = (quality_rules.posterior(votes, prior, fitted) >= 0.5) == good
    assert right.mean() > 0.95


def test_quality_agrees_with_labels(spark, folder, rows_of):
    label = dict(rows_of("labels", "doc_id", "quality"))
    found = QUERIES["op3_quality_rules"](spark, folder).filter("not base_failed").collect()
    pairs = [(r.kept, label[r.doc_id] == 1) for r in found if r.doc_id in label]
    assert all(kept for kept, good in pairs if good)
    assert sum(kept for kept, good in pairs if not good) <= 1


def test_quality_of_odd_rows(odd_documents):
    found = quality_rules.judge(odd_documents.drop("kept"), ["doc_id", "key"]).collect()
    assert len(found) == 9
    assert all(r.base_failed and not r.kept for r in found if r.n_words < 50)
    assert quality_rules.judge(odd_documents.limit(0), ["doc_id"]).count() == 0


def kernel(left: str, right: str) -> float:
    """The three-character subsequence kernel by its definition."""

    def features(word):
        word, found = toxicity.FIRST + word + toxicity.LAST, Counter()
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, len(word)):
                    found[word[i], word[j], word[k]] += toxicity.DECAY ** (k - i + 1)
        return found

    a, b = features(left), features(right)
    norm = sum(v * v for v in a.values()) ** 0.5 * sum(v * v for v in b.values()) ** 0.5
    return sum(v * b[u] for u, v in a.items()) / norm


def test_kernel_equals_its_definition():
    words = ["idiot", "idxiot", "banana", "aaaa", "stupid", "clown"]
    marked = [toxicity.FIRST + w + toxicity.LAST for w in words]
    alphabet = toxicity.Alphabet.of(marked)
    codes = alphabet.encode(marked, toxicity.WIDTH)
    found = toxicity.Landmarks.of(codes).kernel(codes)
    wanted = [[kernel(a, b) for b in words] for a in words]
    assert np.allclose(found, wanted, atol=1e-5)


def test_toxicity_learns_gapped_insults(frame):
    rng = np.random.default_rng(5)
    letters = list("abcdeghilmnoprstu")
    vocabulary = ["".join(rng.choice(letters, rng.integers(4, 9))) for _ in range(600)]

    def text(insults):
        words = list(rng.choice(vocabulary, 60))
        for insult in insults:
            words.insert(int(rng.integers(0, 60)), insult)
        return " ".join(words)

    insults = ["grobian", "lumpenkerl", "schuft"]
    rows = [(i, text(rng.choice(insults, 3) if i % 5 == 0 else [])) for i in range(500)]
    documents = frame("doc_id long, text string, label int", *[(*r, 3) for r in rows])
    labels = frame("doc_id long, toxic int", *[(i, int(i % 5 == 0)) for i in range(400)])
    model = toxicity.train(documents, labels)
    found = toxicity.score(documents, model)
    held = [(r.doc_id % 5 == 0, r.score) for r in found.collect() if r.doc_id >= 400]
    assert all((s >= 0.5) == toxic for toxic, s in held)
    gapped = ["a grob-ian is", "s c h u f t", "ein lumpen_kerl", "g.r.o.b.i.a.n"]
    assert (model.scores(gapped) >= 0.5).all()
    assert model.scores(["", "ordinary words"]).max() < 0.5


def small_toxicity_model(insults, letters):
    rng = np.random.default_rng(11)
    clean = ["".join(rng.choice(letters, rng.integers(4, 10))) for _ in range(800)]
    texts = [" ".join(rng.choice(clean, 40)) for _ in range(200)]
    labels = np.array([float(i % 4 == 0) for i in range(200)])
    texts = [t + " " + insults[i % len(insults)] if labels[i] else t for i, t in enumerate(texts)]
    model = toxicity.fit([(w, 9.0) for w in insults], [(w, 1.0) for w in clean[:700]], texts, labels)
    return model, clean


def test_toxicity_finds_insults_with_inserted_letters():
    insults = ["idiot", "trash", "disgusting", "worthless"]
    model, clean = small_toxicity_model(insults, list("abcdefghilmnoprstuvy"))
    one = ["idxiot", "trqash", "disgxusting", "worthlekss", "idioxt", "traxsh"]
    two = ["ixdioxt", "txraxsh", "disgxustzing", "wxorthlesqs", "dxisguxsting"]
    rest = " ".join(clean[700:730])
    assert (model.scores([f"{rest} {w}" for w in one]) >= 0.5).all()
    assert (model.scores([f"{rest} {w}" for w in two]) >= 0.5).all()
    assert (model.scores(clean[700:]) >= 0.5).mean() < 0.05 and model.scores([rest])[0] < 0.5
    # Every word has the value of the kernel itself.
    marked = [toxicity.FIRST + w + toxicity.LAST for w in [*two, *clean[700:720]]]
    codes = model.alphabet.encode(marked, toxicity.WIDTH)
    by_kernel = model.bias + model.landmarks.kernel(codes) ** toxicity.POWER @ model.weights
    assert np.allclose(model.word_values(marked), by_kernel, atol=1e-3)


def test_toxicity_knows_all_characters():
    letters = list("abcdefghijklmnopqrstuvwxyz0123456789äöüßéèêáíóúñçàâîôû")
    model, clean = small_toxicity_model(["идиот", "дурак", "мерзавец"], letters)
    assert len(model.alphabet.codes) > 60
    rest = " ".join(clean[700:730])
    texts = [f"{rest} идиот", f"{rest} дур-ак", f"{rest} м е р з а в е ц", f"{rest} идхиот"]
    assert (model.scores(texts) >= 0.5).all() and model.scores([rest])[0] < 0.5
    # A character no training word has counts in the word's own norm only, and a large alphabet has no table.
    marked = [toxicity.FIRST + w + toxicity.LAST for w in ("идиот", "идижот", "ид漢иот")]
    alphabet = toxicity.Alphabet.of(marked[:1])
    marks = toxicity.Landmarks.of(alphabet.encode(marked[:1], toxicity.WIDTH))
    codes = alphabet.encode(marked, toxicity.WIDTH)
    wanted = [kernel(w, "идиот") for w in ("идиот", "идижот", "ид漢иот")]
    assert np.allclose(marks.kernel(codes)[:, 0], wanted, atol=1e-5)
    marks.index = None
    assert np.allclose(marks.kernel(codes)[:, 0], wanted, atol=1e-5)


def test_toxicity_without_labels(frame, odd_documents):
    none = frame("doc_id long, toxic int")
    model = toxicity.train(odd_documents, none)
    found = toxicity.score(odd_documents.drop("score"), model).collect()
    assert [r.score for r in found] == [0.0] * 9


def test_toxicity_folds(spark, folder):
    found = QUERIES["op6_toxicity"](spark, folder).collect()
    assert len(found) == 200
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_toxicity_on_held_out_rows(spark):
    """Through the query at scale factor 0.1, whose held-out labels training never sees."""
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [r for r in QUERIES["op6_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    marked = Counter((labels[r.doc_id], r.predicted) for r in found)
    false_marks = marked[0, 1] / (marked[0, 0] + marked[0, 1])
    recall = marked[1, 1] / (marked[1, 0] + marked[1, 1])
    print(f"held out: {false_marks:.3f} of clean texts marked, {recall:.3f} of toxic ones found")
    assert false_marks < 0.02 and recall > 0.9


def test_url_rules_by_brute_force(frame):
    rules = [("net", "/", "block"), ("a.net", "/x", "allow"), ("a.net", "/x/y", "block"),
             ("b.a.net", "/x", "block"), ("c.org", "/", "allow"), ("c.org", "/", "block")]
    hosts = ["net", "a.net", "b.a.net", "c.org", "xa.net", "A.NET", "d.com", "", "net:80"]
    paths = ["", "/", "/x", "/xy", "/x/y", "/x/y/z?q#f", "?x", "#f"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "nothing", "a://b://c.org/", "://net/"]
    urls += ["http://net/"] * 3
    pages = frame("url string, path string, host int, rule int", *[(u, "p", 1, 2) for u in urls])
    table = frame("host string, path string, verdict string", *rules, (None, "/", "block"), ("d.com", None, "block"))
    found = url_filter.apply_rules(pages, table).select("url", "_host", "_path", "_rule", "_verdict")

    def judged(url):
        match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (match[1].lower(), match[2]) if match else ("", "")
        fits = [r for r in rules if ("." + host).endswith("." + r[0]) and path.startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
        return url, host, path, best and best[0] + best[1], best[2] if best else "allow"

    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str(judged(u)) for u in urls)
    assert url_filter.apply_rules(pages, table.limit(0)).filter("_rule is not null").count() == 0


def test_chats_read_back_what_was_written(frame):
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\[/ROLE]$1", "[/NAME]", "[\\INST]", "[", "<", "", None, "é\U0001f600\n"]
    roles = ["user", "assistant", "system", None, "to[/NAME]ol\\"]
    rows = [(c, t, roles[(c + t) % 5], nasty[(3 * c + t) % 10], "n") for c in range(10) for t in range(7)]
    rows += [(None, None, None, None, None), (None, 1, "user", "x", None), (77, 0, "user", "a", "n")]
    turns = frame("conv_id long, turn long, role string, text string, segments string", *rows)
    found = chat_format.read_back(chat_format.format_chats(turns)).collect()
    assert len(found) == 12
    for chat in found:
        mine = [r for r in rows if r[0] == chat.conv_id]
        mine.sort(key=lambda r: (-1 if r[1] is None else r[1]))
        assert [tuple(t) for t in chat.turns] == [(r[2] or "", r[3] or "") for r in mine]
        assert chat.formatted == "".join(s.text for s in chat.segments)


def test_machine_validates_turn_order(frame):
    orders = ["su", "sua", "ua", "uau", "a", "uu", "s", "sau", "uaau"]
    names = {"s": "system", "u": "user", "a": "assistant"}
    rows = [(i, t, names[r], "x") for i, order in enumerate(orders) for t, r in enumerate(order)]
    turns = frame("conv_id long, turn long, role string, text string", *rows)
    found = chat_format.format_chats(turns).orderBy("conv_id").select("valid", "error_turn").collect()
    assert [tuple(r) for r in found] == [
        (True, 0), (True, 0), (True, 0), (True, 0), (False, 1), (False, 2), (False, 0), (False, 2), (False, 3)
    ]
