"""Mixing, pseudonyms, page text and the pipeline."""
import collections
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from bazaar.llm import htmltext, mixing, pii
from tests.llm.conftest import DOCS, SPACE_WORDS, corpus, prose


# --- mixing ---

def targets_by_rounds(sizes, weights=(5, 2, 1), limit=3):
    """The rule as told: share by weight, cut off at the limit, reshare the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, rest = {}, float(sum(sizes.values())), set(names)
    while rest:
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > limit * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = limit * sizes[s]
            left -= target[s]
        rest -= over
    return target


def check_mix(spark, rows):
    got = mixing.mix_sources(spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS size", "2 AS copies")).collect()
    sizes = collections.Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(SPACE_WORDS.findall(t or ""))
    want, taken, biggest = targets_by_rounds(sizes), collections.Counter(), collections.Counter()
    for r in got:
        assert r["size"] == len(SPACE_WORDS.findall(r["text"] or "")) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        biggest[r["source"]] = max(biggest[r["source"]], r["size"])
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 2 * biggest[s] + 1 for s in sizes)
    return got


def test_mix_reaches_targets_and_reruns_agree(spark):
    a = check_mix(spark, corpus(6, 150))
    b = check_mix(spark, corpus(6, 150))
    key = lambda rows: collections.Counter((r["doc_id"], r["text"], r["copies"]) for r in rows)
    assert key(a) == key(b)


def test_mix_with_saturated_and_empty_sources(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 40), None, "tiny" if i < 2 else "zz", 0) for i in range(60)] + [(90, "", None, "empty", 0), (91, None, None, None, 0), (92, "w " * 500, None, "b", 0)]
    check_mix(spark, rows)


def test_mix_matches_sql_and_copies(spark, docs, no_docs):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    sql = {tuple(r) for r in con.execute(mixing.mix_oracle()).fetchall()}
    got = mixing.mix_sources(docs)
    assert {(None if r["doc_id"] is None else r["doc_id"], r["size"], r["source_size"], r["target"], r["copies"] * r["size"]) for r in got.collect()} == {(None if d is None or d != d else int(d), *x) for d, *x in sql}
    out = mixing.emit_copies(got, docs.columns)
    assert out.columns == [*docs.columns, "copy_no"] and out.count() == got.agg(F.sum("copies")).first()[0]
    assert mixing.mix_sources(no_docs).count() == 0


# --- pseudonyms ---

def luhn(s):
    return sum((d if i % 2 == 0 else 2 * d - 9 * (d > 4)) for i, d in enumerate(int(c) for c in reversed(s))) % 10 == 0


def test_values_are_replaced_in_their_format(spark):
    text = ("Call +27 (11) 555-1234 or +1 555 123 4567; card 4111 1111 1111 1111, not 4111-1111-1111-1112. Born 1999-02-28, 28.02.1999, 1999/02/30. "
            "Host 10.0.255.1 not 10.0.256.1, v1.2.3. Mail Jo.Doe+x@mail.example.com! key 0123456789abcdef0123456789abcdef01234567 end 1234567")
    rows = [(1, text), (2, text.upper()), (3, "x 4111111111111111 y"), (4, None), (5, ""), (6, "no numbers"), (7, "4111111111111111")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS pii", "'k' AS value")
    got = {r["doc_id"]: r for r in pii.pseudonymise(df).collect()}
    out = got[1]["text"]
    m = re.fullmatch(r"Call (\+27 \(\d\d\) \d{3}-\d{4}) or (\+1 \d{3} \d{3} \d{4}); card (\d{4} \d{4} \d{4} \d{4}), not 4111-1111-1111-1112\. Born (\d{4}-\d\d-\d\d), (\d\d\.\d\d\.\d{4}), 1999/02/30\. "
                     r"Host (\d+\.\d+\.\d+\.\d+) not 10\.0\.256\.1, v1\.2\.3\. Mail (u[0-9a-f]{20}@example\.invalid)! key ([0-9a-f]{40}) end 1234567", out)
    assert m, out
    card = m[3].replace(" ", "")
    assert luhn(card) and card != "4" + "1" * 15
    y, mo, d = m[4].split("-")
    assert f"{d}.{mo}.{y}" == m[5]  # equal dates stay equal in another format
    assert all(0 <= int(o) < 256 for o in m[6].split("."))
    assert [p["kind"] for p in got[1]["pii"]] == ["phone", "phone", "card", "date", "date", "ip", "email", "secret"]
    assert got[3]["text"] == f"x {card} y" and got[7]["text"] == card
    assert got[2]["pii"][6]["pseudonym"] == got[1]["pii"][6]["pseudonym"]  # case of an address does not count
    assert got[4]["text"] is None and got[4]["pii"] == [] and got[5]["text"] == "" and got[6]["text"] == "no numbers" and got[6]["value"] == "k"
    other = {r["doc_id"]: r["text"] for r in pii.pseudonymise(df, key="another").collect()}
    assert other[7] != got[7]["text"]


def test_cards_beside_other_digit_groups(spark):
    """An expiry, a check code, a number before the card, a date or another card must not hide it."""
    rows = ["4111 1111 1111 1111 12/26", "4111111111111111 123", "26 4111 1111 1111 1111", "4111-1111-1111-1111-12", "4111 1111 1111 1111 2024-05-01", "3782 822463 10005 4111 1111 1111 1111 end",
            "4222222222222 4111 1111 1111 1111 7", "4111 1111 1111 1112 12/26", "4111 1111 1111 1111 12.50", "4111111111111111 10.0.0.1", "1 " * 3000 + "x", "7" * 5000]
    out = [r for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()]
    text, kinds = [r["text"] for r in out], [[p["kind"] for p in r["pii"]] for r in out]
    card = text[1].split()[0]
    grouped = " ".join(card[i:i + 4] for i in range(0, 16, 4))
    assert luhn(card) and card != "4" + "1" * 15
    assert text[0] == f"{grouped} 12/26" and text[1] == f"{card} 123" and text[2] == f"26 {grouped}" and text[3] == grouped.replace(" ", "-") + "-12"
    assert text[4].startswith(grouped + " ") and "2024-05-01" not in text[4] and text[8] == f"{grouped} 12.50" and text[9].startswith(card) and "10.0.0.1" not in text[9]
    assert re.fullmatch(rf"\d{{4}} \d{{6}} \d{{5}} {grouped} end", text[5]) and "3782 822463 10005" not in text[5] and re.fullmatch(rf"\d{{13}} {grouped} 7", text[6])
    assert text[7] == rows[7] and [len(t) for t in text[10:]] == [len(t) for t in rows[10:]]
    assert kinds[:10] == [["card"]] * 4 + [["card", "date"], ["card"] * 2, ["card"] * 2, [], ["card"], ["card", "ip"]]


def feistel(left, right, a, b, key, kind, label=None):
    import hashlib
    tag = "" if label is None else label + ":"
    for i in range(pii.ROUNDS):
        src = right if i % 2 == 0 else left
        f = int(hashlib.sha256(f"{key}/{kind}/{i}/{tag}{src}/{key}".encode()).hexdigest()[:15], 16)
        left, right = ((left + f % a) % a, right) if i % 2 == 0 else (left, (right + f % b) % b)
    return left, right


def inverse(left, right, a, b, key, kind, label=None):
    import hashlib
    tag = "" if label is None else label + ":"
    for i in reversed(range(pii.ROUNDS)):
        src = right if i % 2 == 0 else left
        f = int(hashlib.sha256(f"{key}/{kind}/{i}/{tag}{src}/{key}".encode()).hexdigest()[:15], 16)
        left, right = ((left - f % a) % a, right) if i % 2 == 0 else (left, (right - f % b) % b)
    return left, right


def test_permutations_match_a_plain_version_and_invert(spark):
    rng = random.Random(3)
    values = ["".join(rng.choice("0123456789") for _ in range(n)) for n in (2, 3, 9, 15, 18, 25, 36) for _ in range(5)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", pii.permute_digits(F.col("v"), "k", "card").alias("w")).collect():
        v, n, h = r["v"], len(r["v"]), len(r["v"]) // 2
        left, right = feistel(int(v[:h]), int(v[h:]), 10 ** h, 10 ** (n - h), "k", "card", str(n))
        assert r["w"] == f"{left:0{h}d}{right:0{n - h}d}"
        assert inverse(left, right, 10 ** h, 10 ** (n - h), "k", "card", str(n)) == (int(v[:h]), int(v[h:]))


def test_permutations_are_one_to_one(spark):
    days = spark.range(146097).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("v"))
    assert days.select(pii.date_pseudonym(F.col("v"), "k").alias("w")).agg(F.countDistinct("w"), F.min("w"), F.max("w")).first()[:] == (146097, "1800-01-01", "2199-12-31")
    four = spark.range(10000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"))
    assert four.select(pii.permute_digits(F.col("v"), "k", "x").alias("w")).distinct().count() == 10000


def test_no_python_in_the_plan(docs, no_docs):
    plan = pii.pseudonymise(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.pseudonymise(no_docs).count() == 0


# --- page text ---

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href=/a>Menu one</a></li><li>Menu two</ul></nav>
<div class="cookie-notice">We use cookies, please accept all of them today.</div><div id=wrap><div class="%s"><h2>Title &eacute;&#233;</h2><p>First   para<br>graph with <b>bold</b>, &lt;tags&gt; &amp; more text, and words.
<p>Second one <a href="x">linked</a>, unclosed, with more words to score.<div class="ad">Buy now</div><ul><li>Item one<li>Item <i>two</i></ul>
<table><tr><td>c1<td>c2</table><form><input name=q><button>Send</button></form><aside>Related text</aside><p hidden>gone</p><span class="advert">sponsored</span> tail</div></div>
<section id="comments"><p>A reader's comment, which is long enough to score, with commas, and more, and more, and more words.</p></section>
<footer>&copy; foot</footer></body></html>"""
TEXT = "Title éé\nFirst para graph with bold, <tags> & more text, and words.\nSecond one linked, unclosed, with more words to score.\nItem one\nItem two\nc1\nc2\ntail"


def test_main_text_of_a_page():
    found = htmltext.parse(PAGE % "content post-17")
    best = htmltext.best_container(found)
    assert best.path == ">html>body>div>div.content.post-#" and htmltext.text_of(found, [best]) == TEXT


LONG = "The story itself, with many words in it, so it scores well, and goes on for a while, until it ends. " * 3


@pytest.mark.parametrize("attributes", ["class='content has-sidebar'", "class='no-sidebar'", "class='elementor-widget elementor-widget-theme-post-content'", "class='with-comments'", "data-hidden='false'",
                                        "title='hidden gems'", "data-id='comments'", "class='sidebar'", "id=overlay", "role=form", "class='content-sidebar-wrap'"])
@pytest.mark.parametrize("inner", ["<article><p>%s</p></article>", "<div><p>%s</p></div>"])
def test_wrappers_that_name_a_neighbour_stay(attributes, inner):
    page = f"<body><nav>Menu</nav><div {attributes}>{inner % LONG}<div class='left-sidebar'><p>Other things, to read.</p></div><div class='ad-box'>Buy</div></div><footer>foot</footer></body>"
    found = htmltext.parse(page)
    best = htmltext.best_container(found)
    assert best is not None and htmltext.text_of(found, [best]) == LONG.strip()


def test_form_around_a_page_stays_and_hidden_and_comments_go():
    comments = "<section id='comments'><article class='comment'><p>" + "A longer reader's comment, with commas, and more. " * 40 + "</p></article></section>"
    for page in (f"<body><form id=aspnetForm><div class='main'><p>{LONG}</p></div></form></body>", f"<body><div class='story'><p>{LONG}</p></div>{comments}</body>",
                 f"<body><div hidden><article><p>{LONG * 9}</p></article></div><div class='story'><p>{LONG}</p></div></body>"):
        found = htmltext.parse(page)
        assert htmltext.text_of(found, [htmltext.best_container(found)]) == LONG.strip()


def test_host_consensus_beats_a_single_page(spark):
    noisy = "<html><body><div class='story'><p>Short, true text.</p></div><div class='wide-block'><p>" + "A long block that is repeated, on one page only, " * 6 + "</p></div></body></html>"
    rows = [(i, f"http://Example.com:80/{i}", "<html><body><div class='story'><p>" + f"Story number {i}, with many words in it, so it scores well. " * 4 + "</p></div></body></html>") for i in range(8)]
    rows += [(20, "https://example.com/odd", noisy), (21, "https://other.org/odd", noisy), (22, None, None), (23, "x", ""), (24, None, "plain &amp; simple"), (25, "http://example.com", "<p>No story here, but a paragraph.")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS path")
    got = {r["page_id"]: r["text"] for r in htmltext.extract_text(df).collect()}
    assert got[20] == "Short, true text." and got[21].startswith("A long block") and got[22] == got[23] == "" and got[24] == "plain & simple" and got[25].startswith("No story")
    assert htmltext.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("page", ["<", "<<<p", "<p", "<div", "a < b > c", "<!-- open", "<script>x", "</div></p>x", "<p class='x>y</p>", "<div>" * 300 + "deep", "&#xZZ; &bogus; &#99999999;", "<ul><li>a<ul><li>b</ul><li>c</ul>"])
def test_broken_pages_do_not_crash(page):
    found = htmltext.parse(page)
    best = htmltext.best_container(found)
    assert best is None or isinstance(htmltext.text_of(found, [best]), str)


def test_main_text_of_given_pages(spark):
    """The given pages have one article element each; its blocks by plain splitting."""
    import html
    from bazaar.llm.shared import read_table
    from tests.conftest import SF_MID
    for r in htmltext.extract_text(read_table(spark, SF_MID, "pages")).collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b)


# --- the pipeline ---

def test_pipeline_stages(spark):
    import corpus_pipeline
    from bazaar.llm import decontaminate, langid, minhash
    from bazaar.llm.shared import id_remainder, read_table
    from tests.conftest import SF_SMALL

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark_passages", "pseudonyms", "mixture"]
    docs = read_table(spark, SF_SMALL, "documents")
    odd = spark.createDataFrame([(9001, None, "en", "src0", None), (9002, "", None, None, 0), (9003, "12 34", "en", "src1", 5), (None, prose(random.Random(1), 30), "en", "src1", 5)], docs.schema)
    docs, before = docs.union(odd).withColumn("label", F.lit("x")), None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_SMALL).cache()
        if name != "mixture":
            assert docs.columns == before.columns, name
        ids = lambda d: {r["doc_id"] for r in d.select("doc_id").collect()}
        if name == "language":
            assert not ids(docs) & {9001, 9002, 9003} and len(ids(docs)) >= 195
            assert ids(before) - ids(docs) >= {9001, 9002, 9003}
        elif name == "near_duplicates":
            assert ids(docs) == {r["doc_id"] for r in minhash.near_duplicate_groups(before).where("kept").collect()}
        elif name == "benchmark_passages":
            assert ids(docs) == ids(decontaminate.find_contamination(before, read_table(spark, SF_SMALL, "benchmark")).where("n_hit = 0"))
        elif name == "pseudonyms":
            assert docs.count() == before.count() and all(r["n_chars"] == len(r["text"]) for r in docs.collect())
            assert not docs.where(F.col("text").rlike(r"@mail\d")).count()
        else:
            assert docs.columns == [*before.columns, "copy_no"]
            want = mixing.mix_sources(before).agg(F.sum("copies")).first()[0]
            assert docs.count() == want and ids(docs) <= ids(before)
    assert langid.UNKNOWN == "und" and id_remainder(5) is not None


def test_pipeline_on_an_empty_table(spark, no_docs):
    import corpus_pipeline
    from tests.conftest import SF_SMALL
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def _pseudonyms(spark, texts):
    out = pii.pseudonymise(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4))
    return {r["doc_id"]: (r["text"], [p["kind"] for p in r["pii"]]) for r in out.collect()}


def test_tables_of_numbers_stay(spark):
    rng = random.Random(8)
    tables = [" ".join(str(rng.randint(10, 99)) for _ in range(600)), " ".join(str(rng.randint(0, 9)) for _ in range(600)), " ".join(str(rng.randint(1900, 2030)) for _ in range(600)), "1995-1996-1997-1998-1999"]
    for _ in range(1500):
        low, high = rng.choice([(0, 9), (10, 99), (100, 999), (1000, 9999), (0, 99999)])
        tables.append(rng.choice([" ", "-"]).join(str(rng.randint(low, high)) for _ in range(rng.randint(20, 120))))
    got = _pseudonyms(spark, tables)
    assert all(got[i][0] == tables[i] for i in range(4))
    changed = sum(a != b for i, t in enumerate(tables) for a, b in zip(re.split("[ -]", t), re.split("[ -]", got[i][0])))
    assert changed < 0.001 * sum(len(re.split("[ -]", t)) for t in tables)


def test_cards_beside_other_numbers_are_found(spark):
    texts = ["4111 1111 1111 1111 12/26", "4111111111111111 123", "pay 5500-0000-0000-0004 now", "378282246310005", "3782 822463 10005 09 28", "7 4111 1111 1111 1111 8 5500 0000 0000 0004", "4111 1111 1111 1111 12 26 123"]
    for i, (text, kinds) in _pseudonyms(spark, texts).items():
        assert "card" in kinds and "4111" not in text and "0000" not in text and "822463" not in text, texts[i]


def test_working_names_of_pseudonyms(spark):
    df = spark.createDataFrame([(1, "mail a.b@example.org", "s", "p")], "doc_id long, text string, _swaps string, own string")
    row = pii.pseudonymise(df).first()
    assert row["_swaps"] == "s" and row["own"] == "p" and len(row["pii"]) == 1
