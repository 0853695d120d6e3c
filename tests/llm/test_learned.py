"""Operators with a model or a rule of their own: toxicity, sentence spans, URL rules, main text, and the pipeline."""

import math
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from namewright.llm import html_text, queries, sentences, toxicity, url_rules
from namewright.llm.hashing import WHITE, Words
from tests.llm import plain
from tests.llm.conftest import PASSAGE, rows

LABELS = "doc_id long, quality int, toxic int, text string"


# -- toxicity --------------------------------------------------------------------------------


@given(st.lists(st.integers(-5, 5), max_size=30))
@settings(max_examples=300, deadline=None)
def test_maximal_segments_by_definition(scores):
    noisy = [s + 1e-3 * math.sin(7 * k + 1) for k, s in enumerate(scores)]  # no ties
    got = toxicity.maximal_segments(noisy)
    want = plain.best_segments(noisy)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]


@pytest.fixture(scope="module")
def marked(spark):
    random.seed(11)
    calm = [f"calm{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        w = random.choices(calm, k=random.randint(20, 80))
        bad = i % 6 == 0
        if bad:
            at = random.randrange(len(w))
            w[at:at] = [random.choice(["vile", "foulness", "foulest", "foulmouth"]) for _ in range(4)]
        docs.append((i, " ".join(w), "row"))
        if i % 2 == 0 or i < 200:
            labels.append((i, 1, int(bad), "x"))
    docs += [(1000, None, "x"), (1001, "", "x"), (None, "calm1 vile", "x"), (1002, "foulx vile foulness", "x"), (1003, "vile " * 4000, "x")]
    labels += [(0, 1, None, "x"), (None, 1, 1, "x"), (0, 1, 1, "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, row string"), spark.createDataFrame(labels, LABELS)


def test_toxicity_separates_held_out_documents(marked):
    docs, labels = marked
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model, ["doc_id", toxicity.held_out().alias("held_out")]).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    own = {r.doc_id: r for r in got if r.doc_id is not None}
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert held and all((r.score >= 0.3) == (r.doc_id % 6 == 0) for r in held)
    assert own[1002].score >= 0.3 and own[1003].score >= 0.3 and own[1000].score == own[1001].score < 0.3
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in held:
        for s in r.segments:
            assert any(w.startswith(("vile", "foul")) for w in text[r.doc_id].split()[s["first"] : s["stop"]])
    assert {r.doc_id for r in toxicity.reject(docs, labels).collect()} >= {r.doc_id for r in held if r.doc_id % 6}


@pytest.mark.parametrize("floor", [0.5, 2.0])
def test_toxic_terms_equal_plain_counts(marked, floor):
    docs, labels = marked
    toxic = {}
    for r in labels.collect():
        if r.doc_id is not None and r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != toxicity.HELD_OUT:
            toxic[r.doc_id] = max(r.toxic, toxic.get(r.doc_id, 0))
    training = [(toxic[r.doc_id], r.text) for r in docs.collect() if r.doc_id in toxic]
    want = plain.toxic_terms(training, toxicity.PRIOR, 2.0, floor)
    got = toxicity.fit(docs, labels, least_z=2.0, floors=(floor,)).weights
    assert want and got == pytest.approx(want)


def test_many_labels_do_not_let_weak_terms_in(spark):
    """Words a little more frequent in toxic rows become significant as rows grow; the training folds choose a floor above them."""
    random.seed(5)
    docs, labels = [], []
    for i in range(6000):
        bad = i % 8 == 0
        w = [f"{random.choice('abcdefgh')}{k}" for k in range(40) for _ in range(1)]
        w += [f"weak{chr(97 + k)}x" for k in range(20) if random.random() < (0.30 if bad else 0.20)]
        w += ["vile", "vile"] if bad else []
        random.shuffle(w)
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(bad), "x"))
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))
    assert "vile" in model.weights and not [t for t in model.weights if t.startswith("weak")]


def test_toxicity_without_labels_or_rows(marked, no_docs, spark):
    docs, labels = marked
    none = spark.createDataFrame([], LABELS)
    assert toxicity.reject(docs, none).count() == docs.count()
    assert toxicity.reject(no_docs, labels).columns == no_docs.columns
    assert toxicity.reject(no_docs, none).count() == 0


# -- sentence spans --------------------------------------------------------------------------


def test_later_copies_of_a_passage_go(awkward):
    got = {r.doc_id: r for r in sentences.remove_repeats(awkward.where("doc_id < 8"), ["doc_id"]).collect()}
    assert got[1].n_removed == 0 and got[3].n_removed > 0
    assert "bridge was built" not in got[2].kept_text and "Something in between" in got[2].kept_text
    assert "harbour district" in got[2].kept_text and got[3].kept_text.strip() == got[4].kept_text.strip() == ""
    kept = sentences.dedup(awkward)
    assert kept.columns == awkward.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not {3, 4} & ids and {None, 1, 2, 5, 8, 9, 10, 11, 12, 15, 16} <= ids


def test_spans_equal_plain_spans(awkward, plain_docs):
    """Every sentence under a span (as text) that also starts earlier is removed, and no other."""
    docs = sorted({d for d in plain_docs if d[0] is not None and d[1]}, key=lambda d: d[0])
    first, want = {}, {}
    for doc, text in docs:
        w = Words([text.encode()], WHITE)
        starts = sentences.sentence_starts(w).tolist()
        words = text.encode().split()
        ends = [*starts[1:], len(words)]
        gone = set()
        for i in range(len(starts)):
            j = next((j for j in range(i + 3, len(starts) + 1) if ends[j - 1] - starts[i] >= 20), None)
            if j is not None:
                span = tuple(words[starts[i] : ends[j - 1]])
                if first.setdefault(span, (doc, i)) != (doc, i):
                    gone |= set(range(i, j))
        want[doc] = (len(starts), len(gone))
    got = sentences.remove_repeats(awkward.where("doc_id is not null and text <> ''"), ["doc_id"])
    assert {r.doc_id: (r.n_sentences, r.n_removed) for r in got.collect()} == want


def test_every_repeated_run_is_covered_up_to_its_end(spark, tmp_path):
    """Against all runs of at least 3 sentences and 20 words, in texts that share runs of any length at any place."""
    rng = random.Random(7)

    def sentence(n):
        return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n)) + "."

    shared = [sentence(n) for n in (15, 5, 5, 4)]
    texts = [" ".join([sentence(6), *shared, sentence(7)]), " ".join([sentence(8), *shared, sentence(5)])]
    pool = [sentence(rng.choice((4, 4, 5, 6, 9, 16))) for _ in range(60)]
    for _ in range(40):
        at = rng.randrange(50)
        texts.append(" ".join([sentence(5), *pool[at : at + rng.randint(1, 9)], sentence(6), *pool[: rng.randrange(8)]]))
    first, want, cut = {}, {}, {}
    for doc, text in enumerate(texts):
        parts = [x + "." for x in text.split(".")[:-1]]
        gone = set()
        for i in range(len(parts)):
            for j in range(i + 3, len(parts) + 1):
                words = " ".join(parts[i:j]).split()
                if len(words) >= 20 and first.setdefault(tuple(words), (doc, i)) != (doc, i):
                    gone |= set(range(i, j))
        want[doc], cut[doc] = (len(parts), len(gone)), [x for k, x in enumerate(parts) if k not in gone]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op7_sentence_spans(spark, str(tmp_path)).collect()
    assert want[1] == (6, 4)
    assert {r.doc_id: (r.n_sentences, r.n_removed) for r in got} == want
    assert {r.doc_id: r.kept_text.split() for r in got} == {k: "".join(v).split() for k, v in cut.items()}
    assert {r.doc_id: r.text.split() for r in sentences.dedup(docs).collect()} == {k: "".join(v).split() for k, v in cut.items() if v}


def test_sentence_starts_do_not_depend_on_what_stands_before():
    def tail(prefix):
        w = Words([f"{prefix} {PASSAGE}".encode()], WHITE)
        starts = sentences.sentence_starts(w)
        return [len(w.start) - s for s in starts.tolist() if len(w.start) - s <= 30]

    assert tail("Some words here are new.") == tail("Other") == tail("a b c d e f g h i j k l m n o p q r s t u v w x y z")


def test_spans_of_nothing(no_docs):
    assert sentences.remove_repeats(no_docs, ["doc_id"]).count() == 0


# -- URL rules -------------------------------------------------------------------------------


def test_explicit_rules(spark):
    urls = {
        "https://Sub.Example.ORG/es/1": ("sub.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12?x=/es/": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/22#/en/1": ("example.org", "/en/22", "org/", "allow"),
        "http://badexample.org/es/1": ("badexample.org", "/es/1", "org/", "allow"),
        "ftp://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "ftp://a.com/fr/x": ("a.com", "/fr/x", "com/fr/", "allow"),
        "http://a.com?q=/de/": ("a.com", "", None, "allow"),
        "x://y://z.org/": ("y:", "//z.org/", None, "allow"),
        "no scheme.org/es/": ("", "", None, "allow"),
        "http://org": ("org", "", None, "allow"),
        "http://org/": ("org", "/", "org/", "allow"),
        "": ("", "", None, "allow"),
    }
    table = [(k, u, "x") for k, u in enumerate(urls)] + [(90, None, "x"), (None, "http://org/", "x"), (0, next(iter(urls)), "x")]
    pages = spark.createDataFrame(table, "page_id long, url string, host string")
    labels = spark.createDataFrame([], LABELS)
    got = url_rules.judge(pages, labels, ["page_id"]).collect()
    assert len(got) == len(table)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert [by[k] for k in range(len(urls))] == list(urls.values())
    assert by[90] == ("", "", None, "allow")


def test_mined_rules_equal_counting(spark):
    random.seed(2)
    pages, labels = [], []
    for i in range(400):
        farm, feed = i % 4 == 0, i % 3 == 0
        host = "farm" if farm else f"site{i % 7}"
        pages.append((i, f"https://{host}.example.net/{random.choice(['a', 'b'])}/{i}" + ("?ref=feed" if feed else "")))
        labels.append((i, int(not (farm and feed) and i % 50 != 1), 0, "x"))
    labels += [(0, 1, 0, "x"), (1, None, 0, "x")]
    table, marks = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, LABELS)
    got = {r.page_id: r.verdict for r in url_rules.judge(table, marks, ["page_id"]).collect()}
    assert all((got[i] == "block") == (i % 12 == 0) for i in range(400))
    urls = url_rules.split_urls(table).withColumn("tokens", url_rules.tokens())
    data = urls.selectExpr("tokens", "cast(page_id % 12 = 0 as int) as bad")
    all_rows = [(set(r.tokens), r.bad) for r in data.collect()]
    rules = url_rules.mine(data).collect()
    assert rules
    for r in rules:
        held = [bad for tokens, bad in all_rows if set(r["items"]) <= tokens]
        assert r.support == len(held) and abs(r.confidence - sum(held) / len(held)) < 1e-9 and r.confidence >= 0.5


def test_rules_hold_query_values(spark):
    pages = [(i, f"https://site.example.net/a/{i}?utm_source={'spam' if i % 4 == 0 else 'feed'}") for i in range(200)]
    labels = [(i, int(i % 4 != 0), 0, "x") for i in range(200)]
    got = url_rules.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, LABELS), ["page_id"]).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(0, 200, 4))


def _template(n_keys, n=240):
    """Bad URLs, every other one of a template of ``n_keys`` query keys; feeds with some of these keys that are good."""
    random.seed(n_keys)
    pages, labels = [], []
    for i in range(n):
        keys = [f"k{chr(97 + k)}={k}" for k in range(n_keys)] if i % 8 == 0 else random.sample([f"f{k}=1" for k in range(6)], 2)
        pages.append((i, f"https://{'farm.' if i % 4 == 0 else ''}{random.choice(['a', 'b'])}.example.net/x/{i}?" + "&".join(keys)))
        labels.append((i, int(i % 4 != 0 or i % 24 == 4), 0, "x"))
    pages += [(n + k, f"https://new.example.org/x?k{chr(97 + k)}={k}") for k in range(n_keys)] + [(n + 50, "https://farm.z.example.net/y"), (n + 51, "https://a.example.net/y?f1=1")]
    return pages, labels


def test_merged_tokens_give_the_verdicts_of_all_combinations(spark):
    """Against every token combination of up to six tokens, each counted by itself."""
    pages, labels = _template(2)
    table, marks = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, LABELS)
    tokens = {r.page_id: set(r.tokens) for r in url_rules.split_urls(table).withColumn("tokens", url_rules.tokens()).collect()}
    data = [(tokens[i], 1 - quality) for i, quality, *_ in labels]
    bad = [t for t, b in data if b]
    least = max(url_rules.MIN_COUNT, math.ceil(url_rules.MIN_SUPPORT * len(bad)))
    common = {t for t in set().union(*bad) if sum(t in x for x, _ in data) < 0.9 * len(data)}
    rules, level = [], [frozenset()]
    while level:
        level = {s | {t} for s in level for t in common - s if sum(s | {t} <= x for x in bad) >= least}
        rules += [s for s in level if sum(s <= x for x in bad) >= 0.5 * sum(s <= x for x, _ in data)]
    got = {r.page_id: r.verdict for r in url_rules.judge(table, marks, ["page_id"], rules=[]).collect()}
    want = {i: "block" if any(s <= t for s in rules) else "allow" for i, t in tokens.items()}
    assert got == want and set(want.values()) == {"block", "allow"}


def test_a_template_of_many_keys_is_one_item(spark):
    pages, labels = _template(20)
    table, marks = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, LABELS)
    rules = url_rules.mine(url_rules.split_urls(table).withColumn("tokens", url_rules.tokens()).join(marks, table.page_id == marks.doc_id).selectExpr("tokens", "1 - quality AS bad")).collect()
    assert 0 < len(rules) < 50
    template = [r for r in rules if any("v:ka=0" in some for some in r.alternatives)]
    assert len(template) == 1 and len(template[0]["items"]) == 1 and len(template[0].alternatives[0]) == 40
    got = {r.page_id: r.verdict for r in url_rules.judge(table, marks, ["page_id"], rules=[]).collect()}
    assert all(got[i] == "block" for i in range(0, 240, 8)) and all(got[240 + k] == "block" for k in range(20)) and got[291] == "allow"


def test_very_long_urls(spark):
    pages = [(i, f"https://a.example.net/{i}?" + "&".join(f"p{k}={i % 2}" for k in range(3000))) for i in range(30)] + [(99, "http://" + "x" * 100_000 + "/" + "y/" * 50_000)]
    got = url_rules.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame([(i, i % 2, 0, "x") for i in range(30)], LABELS), ["page_id"]).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(0, 30, 2)) and len(got) == 31


def test_urls_of_nothing(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(none, spark.createDataFrame([], LABELS), ["page_id"]).count() == 0


# -- main text -------------------------------------------------------------------------------

MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/x">News of the day</a></li></ul></nav>'
LONG = "The council said that the bridge would be closed for the summer and that the ferry would take its place, as it had in the years before the war."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words only", "plain words only"),
        (f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{MENU}<article><h1>Head</h1><p><b>{LONG}<br><p>Is.</article><footer>&copy; 2024</footer>", f"Head {LONG} Is."),
        (f"<article><p>a&amp;b &lt;tag&gt; x<b>y</b>z\n\n  end</p><div class='comments'><p>{LONG}</p></div></article>", "a&b <tag> xyz end"),
        (f"<body>{MENU}<div id=cookie-notice>We use cookies. {LONG}</div><div><h2>Head</h2><p>{LONG}</p><p>Short one.</p></div><aside>{LONG}</aside><form>{LONG}<input></form><p><a href=x>More of this and that</a></p></body>", f"Head {LONG} Short one."),
        ("<article>Only short.</article><footer>no</footer>", "Only short."),
        (f"<header>{LONG}</header><main><header><h1>Real</h1></header><p>{LONG}</p></main>", f"Real {LONG}"),
        (f"<p>{LONG}</p><!-- {LONG} --><p hidden>{LONG}</p><p>cut <a", f"{LONG} cut"),
        ("<article><p>x</p><script>if (a<b) {</article>", "x"),
        ("<article><div class='article-header'><h1>Head</h1></div><p hidden>no<p>yes</article>", "Head yes"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


RUSSIAN = "Городской совет сообщил, что мост будет закрыт на всё лето и что вместо него пойдёт паром, как это было в годы перед войной, когда старые опоры меняли на новые каменные."
CHINESE = "市议会表示,这座桥整个夏天都将关闭,渡船会代替它运送行人和车辆,就像战前那些年里一样,当时旧的木桩正在换成新的石墩。"
FINNISH = "Kaupunginvaltuusto ilmoitti, että silta suljetaan koko kesäksi ja että lautta kuljettaa ihmiset joen yli samalla tavalla kuin sotaa edeltäneinä vuosina, jolloin vanhat pilarit vaihdettiin."
LINKS = '<div><a href="/">Home</a> <a href="/x">News</a></div>'


@pytest.mark.parametrize("prose", [RUSSIAN, CHINESE, FINNISH])
def test_pages_without_article_in_another_language(prose):
    page = f"<body>{LINKS}<div><h1>Alpha</h1><p>{prose}</p><p>Beta.</p><p>{prose}</p></div><div class=footer>{prose}</div>{LINKS}</body>"
    assert html_text.main_text(page) == f"Alpha {prose} Beta. {prose}"


_SIZES = st.sampled_from([3, 40, 139, 140, 600])


@given(st.lists(st.tuples(st.sampled_from(["chrome", "main", "body"]), _SIZES, st.sampled_from([0.0, 0.2, 0.3, 0.6]), st.sampled_from([0.0, 0.06, 0.3]), st.booleans(), st.booleans()), max_size=9))
@settings(max_examples=1500, deadline=None)
def test_two_passes_equal_the_rules_block_by_block(shape):
    found = []
    for region, size, linked, stops, heading, marked in shape:
        b = html_text._Block(region, heading)
        words = ["the" if k < stops * 50 else "quux" for k in range(50)]
        b.text = ("©" if marked else "") + " ".join(words)
        b.links = size, linked
        found.append(b)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(html_text, "_size", lambda b: b.links[0])
        patch.setattr(html_text, "_linked", lambda b: b.links[1])
        html_text._first_pass(found)
        html_text._second_pass(found)
    assert [b.label for b in found] == plain.block_labels(shape)


def test_densities_decide_most_blocks_of_the_given_pages(sf, spark):
    """Blocks outside menus, footers and the like: labelled by pass one, or by their neighbours in pass two."""
    first = second = 0
    for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect():
        found = [b for b in html_text.blocks(r.html or "") if b.region != "chrome"]
        html_text._first_pass(found)
        first += sum(b.label is not None for b in found)
        second += sum(b.label is None for b in found)
    assert first > 50 and second > 50


def test_lists_and_code_of_a_page_without_article_stay():
    code = "<pre>" + "\n".join(f"def step_{k}(value): return value * {k} + offset[{k}]" for k in range(30)) + "</pre>"
    table = "<table>" + "".join(f"<tr><td>Station {k}</td><td>{k * 17 % 101}</td><td>kWh</td></tr>" for k in range(20)) + "</table>"
    page = f"<body>{LINKS}<div><h2>Use</h2><p>{LONG}</p>{code}<p>{LONG}</p>{table}<p>Built in 1911, © the town.</p></div><div class=footer>© 2024 Company</div></body>"
    text = html_text.main_text(page)
    assert text.startswith(f"Use {LONG} def step_0") and "step_29" in text and "Station 19" in text and "© the town." in text
    assert "Home" not in text and "Company" not in text
    assert html_text.main_text(f"<div><p>{LONG}</p></div><div>© 2024 Some Company</div>") == LONG


def test_stop_words_decide_where_the_language_is_known():
    names = "Aalto Berg Calder Dorn Ekman Falk Grim Holt Ibsen Jarl Krag Lund Moe Nord Olsen Prag Quist Rask Stang Thor Ulv Vang Wold Yngve Zorn Aker Brandt Cappel"
    # a long block of few stop words is undecided: it goes with its neighbours
    assert html_text.main_text(f"<div><p>{LONG}</p><p>{names}</p></div>") == f"{LONG} {names}"
    assert html_text.main_text(f"<div><p>{LONG}</p></div>{LINKS}<p>{names}</p>{LINKS}") == LONG
    assert html_text.main_text(f"<div><p>{names}</p></div>{LINKS}") == names
    assert html_text.main_text(f"<div><p>{LONG}</p><p>{RUSSIAN}</p></div>") == f"{LONG} {RUSSIAN}"


def test_links_decide_inside_an_article():
    links = "<ul>" + "".join(f"<li><a href=/{k}>Another story of the harbour {k}</a></li>" for k in range(9)) + "</ul>"
    assert html_text.main_text(f"<article><h1><a href=/>Head</a></h1><p>{LONG}</p><p>Short <a href=/>one</a> stays here.</p>{links}<p>Last.</p></article>") == f"Head {LONG} Short one stays here. Last."
    assert html_text.main_text("<main><p><a href=/>Only a link</a></p></main>") == "Only a link"


def test_pages_and_clashing_names(spark):
    pages = spark.createDataFrame([(1, None, "<article>a</article>", "x"), (None, "u", None, "y"), (1, None, "<article>a</article>", "x")], "page_id long, url string, html string, text string")
    assert rows(html_text.extract(pages, ["page_id", "url"]), "page_id", "url", "text", "n_chars") == [(None, "u", "", 0), (1, None, "a", 1), (1, None, "a", 1)]
    assert html_text.extract(pages.limit(0), ["page_id"]).count() == 0


def test_very_long_pages_take_linear_time():
    page = "<div>" * 20000 + "<a title=\"" * 2000 + LONG + "</div>" * 20000
    assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("<article>" + "<p>word</p>" * 50000 + "</article>").count("word") == 50000


# -- pipeline --------------------------------------------------------------------------------


def test_stages_take_effect(spark, sf, tmp_path):
    before = spark.read.parquet(f"{sf}/documents.parquet")
    docs, seen = before, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == before.columns and out.dtypes == before.dtypes
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs.count())
    stages = [spark.read.parquet(str(tmp_path / str(k))) for k in range(4)]
    texts = [[(r.doc_id, r.text) for r in s.collect()] for s in stages]
    assert {i for i, *_, kept in plain.near_duplicates(texts[0]) if kept} == {i for i, _ in texts[1]}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert {r[0] for r in plain.decontaminated(texts[2], items) if not r[-1]} == {i for i, _ in texts[3]}
    assert {r.doc_id for r in docs.collect()} == {i for i, _ in texts[3]}
    assert before.count() >= seen[0] > seen[1] >= seen[2] > seen[3]


def _run(spark, awkward, tmp_path, labels, items):
    folder = f"{tmp_path}/tables"
    awkward.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == awkward.columns and docs.dtypes == awkward.dtypes
        docs.write.parquet(f"{folder}/stage{len(kept)}")
        docs = spark.read.parquet(f"{folder}/stage{len(kept)}")
        kept.append(docs.collect())
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept[-1]}
    assert sum(r.piece == 0 for r in packed) == len(kept[-1])
    return kept, packed


def test_pipeline_on_awkward_rows(spark, awkward, tmp_path):
    """Nulls, empty and very long texts, repeated rows, clashing column names; every stage against its plain version."""
    items = [(1, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (2, None), (None, "")]
    kept, _ = _run(spark, awkward.unionByName(awkward.where("doc_id is null")), tmp_path, [(1, 1, 0, "x"), (3, 1, None, "x"), (None, 1, 1, "x")], items)
    clean, distinct, shorter, last = kept
    assert len(clean) == awkward.count() + 2  # no toxic label, nothing goes
    named = [(r.doc_id, r.text) for r in clean]
    first = {(i, t) for (i, t), (_, _, _, keep) in zip(named, plain.near_duplicates(named), strict=True) if keep}
    assert sorted(((r.doc_id, r.text) for r in distinct), key=str) == sorted(first, key=str)  # one row of each id and text
    text = {r.doc_id: r.text for r in shorter}
    assert "bridge was built" in text[1] and "bridge was built" not in text[2]
    assert {r.doc_id for r in shorter} == {r.doc_id for r in distinct} - {3}
    hit = {d for d, _, n, *_ in plain.decontaminated([(r.doc_id, r.text) for r in shorter], items) if n}
    assert {5} <= hit and {r.doc_id for r in last} == {r.doc_id for r in shorter} - hit


def test_pipeline_of_empty_tables(spark, awkward, no_docs, tmp_path):
    assert _run(spark, no_docs, f"{tmp_path}/none", [], [])[1] == []
    kept, packed = _run(spark, awkward.where("doc_id in (8, 9, 11)"), f"{tmp_path}/few", [], [])
    assert {r.doc_id for r in packed} == {8, 9, 11} == {r.doc_id for r in kept[-1]}
