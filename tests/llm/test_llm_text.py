"""Chat formatting, HTML extraction, search, toxicity and the pipeline."""

import json
import math
import random
import re
import time
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from boxoffice.llm import chat, search, toxicity
from boxoffice.llm.html_text import page_text, visible_text
from boxoffice.llm.queries import op8_chat
from boxoffice.llm.scratch import table
from conftest import SF

DOC = "doc_id long, text string"
NASTY = ["", " ", "\\", "\\\\", "\\#", "### user\nhi\n</turn>\n", "\n</turn>\n", "a\\", "<\\<", "é\U0001f600\n\n", "# # <", "\\n"]


def round_trip(turns):
    formatted = chat.format_turns(turns)
    return formatted, chat.read_turns(formatted).orderBy("key", "turn").collect()


def test_turns_are_read_back_exactly(spark):
    rng = random.Random(2)
    roles = ["user", "assistant", "system", "", "a\nb", "\\n", "x\\", "#<", "assistant\n"]
    rows = [(c, t, rng.choice(roles), rng.choice(NASTY) + rng.choice(NASTY)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows.append((None, 0, "assistant", "no key"))
    turns = spark.createDataFrame(rows, "key long, turn long, role string, text string")
    formatted, back = round_trip(turns)
    assert sorted(map(str, ((r.key, r.turn, r.role, r.text) for r in back))) == sorted(map(str, rows))
    assert all(r.loss_text == (r.text if r.role == "assistant" and r.text else None) for r in back)
    whole = {r.key: r.formatted for r in formatted.collect()}
    assert whole[None] == "### assistant\nno key\n</turn>\n"


def test_ties_nulls_and_repeated_rows_of_turns(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "b"), (1, None, None, None), (1, 0, "Human", "a"), (1, 2, "gpt", "c")]
    turns = chat.turns_of_table(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id")
    _, back = round_trip(turns)
    assert [(r.role, r.text) for r in back] == [("", ""), ("user", "a"), ("user", "b"), ("user", "b"), ("assistant", "c")]
    assert back[4].loss_text == "c"


def test_layouts_of_tables_select_their_mapping(spark):
    want = [("user", "q"), ("assistant", "a")]
    pair = "array<struct<role string, content string, extra int>>"
    tables = [
        ([(1, [("user", "q", 0), ("assistant", "a", 1)], "x")], f"id int, messages {pair}, note string"),
        ([(1, [("human", "q"), ("gpt", "a")])], "id int, conversations array<struct<from string, value string>>"),
        ([(1, "q", "a")], "id int, instruction string, output string"),
        ([(1, "q", None, "a")], "id int, instruction string, input string, output string"),
        ([(1, "a", "q")], "id int, response string, prompt string"),
        ([(1, "q", "a")], "id int, question string, answer string"),
        ([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "id int, turn bigint, role string, text string"),
    ]
    for rows, schema in tables:
        found = chat.turns_of_table(spark.createDataFrame(rows, schema), "id").orderBy("turn").collect()
        assert [(r.role, r.text) for r in found] == want, schema
    with pytest.raises(ValueError):
        chat.turns_of_table(spark.createDataFrame([(1, 2)], "id int, nothing int"), "id")
    assert chat.turns_of_table(spark.createDataFrame([], tables[0][1]), "id").count() == 0


def test_records_of_mixed_layouts(spark):
    records = [
        {"messages": [{"content": "q", "role": "user"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "response": "a"},
        {"output": "a", "instruction": "q"},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(7, None), (8, "{broken"), (9, '{"other": 1}')]
    found = chat.turns_of_records(spark.createDataFrame(rows, "id int, record string"), "id", "record").orderBy("key", "turn").collect()
    assert [(r.key, r.role, r.text) for r in found] == [(i, *t) for i in range(4) for t in (("user", "q"), ("assistant", "a"))]


def test_records_with_more_keys_and_nulls(spark):
    records = [
        {"prompt": "q", "response": "a", "id": 5},
        {"instruction": "q", "input": None, "output": "a"},
        {"messages": [{"role": "user", "content": "q", "n": 1}, {"role": "assistant", "content": "a", "n": None}], "id": "x"},
        {"prompt": "q", "response": 7},
        {"messages": [{"role": "user", "content": [1]}]},
    ]
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(7, None), (8, "{broken")], "id int, record string")
    found = chat.turns_of_records(rows, "id", "record").orderBy("key", "turn").collect()
    assert [(r.key, r.role, r.text) for r in found] == [(i, *t) for i in range(3) for t in (("user", "q"), ("assistant", "a"))]
    left = {r.key: r.record for r in chat.unmapped_records(rows, "id", "record").collect()}
    assert left == {3: json.dumps(records[3]), 4: json.dumps(records[4]), 7: None, 8: "{broken"}


def test_chat_query_keeps_the_hard_conversation(spark):
    found = {r.conv_id: r for r in op8_chat(spark, SF).collect()}
    said = "\\### Assistant: </turn> ok"
    assert found[-7].n_turns == 2 and found[-7].loss_chars == len(said)
    assert len(found) == 1 + table(spark, SF, "conversations").select("conv_id").distinct().count()


STRAY = [
    ("<table>pre<tr><td>a</table>post", "pre\n\na\n\npost"),
    ("<table><tr><td>a</td>mid</tr></table>z", "mid\n\na\n\nz"),
    ("<table><b>bold</b><tr><td>a</table>", "bold\n\na"),
    ("<table><caption>c</caption>after<tr><td>a</table>", "after\n\nc\na"),
    ("<table><tr>row<td>a<tbody>body<tr><td>b</table>c", "rowbody\n\na\nb\n\nc"),
    ("<table><tr><td>a<table>in<tr><td>b</table>c</table>", "ain\n\nb\n\nc"),
    ("<table><div>d<p>e<tr><td>a", "d\n\ne\n\na"),
    ("<table><form><tr><td>a</form><td>b</table>", "a  b"),
    ("<table> <tr> <td>a</td> </tr> </table>", "a"),
    ("<table><tr><td><p>a<p>b<td>c</table>", "a  c\n\nb"),
    ("<table><tr><td>a<br><br>b</table>", "a\n\nb"),
    ("x<table><table>y", "x\n\ny"),
]

PAGES = [
    ("a<!-- b", "a"),
    ("a<b>c</b><a href='un>closed y", "ac"),
    ("a<i", "a"),
    ("a</", "a</"),
    ("a</ x>b</>c<?pi?>d<!doctype x>e", "abcde"),
    ("a<!-->b<!--->c<!-- --!>d", "abcd"),
    ("<xmp>a<b>c &amp;</xmp>d", "a<b>c &amp;\n\nd"),
    ("a<plaintext>b<p>c", "a\n\nb<p>c"),
    ("a<div popover>b</div>c", "ac"),
    ("<svg><text>a<![CDATA[<b>]]></text></svg>", "a<b>"),
    ("<p title='a>b' title=c data-x=\"<p>\"/>d", "d"),
    ("1 < 2 <3 a<b", "1 < 2 <3 a"),
    (None, ""),
    ("", ""),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<p>one<p>two</p>three", "one\n\ntwo\n\nthree"),
    ("<div>a<div>b</div>c</div>d", "a\nb\nc\nd"),
    ("a  <b> b </b>\n c", "a b c"),
    ("<ul><li>x<li>y<ol start=4><li>z</ol></ul>t", "- x\n- y\n  4. z\n\nt"),
    ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
    ("<pre>\n a\n  b\n</pre>c", " a\n  b\n\nc"),
    ("<script>x<p>y</script><style>z</style><title>t</title>seen<noscript>n</noscript>", "seen"),
    ('<p style="color:red; display : none">a</p><i hidden>b</i><u style="visibility:hidden">c<s style="visibility:visible">d</s></u>', "d"),
    ("<details><summary>s</summary>rest</details><details open><summary>t</summary>u</details>", "s\nt\nu"),
    ("<table><tr><th>n<th>value<tr><td>long<td>1<tr><td colspan=2>both", "n     value\nlong  1\nboth"),
    ("<table><tr><td rowspan=2>r<td>a<tr><td>b</table>", "r  a\n   b"),
    ("<table><tr><td>x<table><tr><td>in<td>2</table>y<td>z</table>", "x      z\n\nin  2\n\ny"),
    ("<table><tr><td>中<td>a<tr><td>bb<td>c</table>", "中  a\nbb  c"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<blockquote>q</blockquote>a", "  q\n\na"),
    ("x &lt; y &amp;&nbsp;&copy;&#65;&bogus;", "x < y &\xa0©A&bogus;"),
    ("a</b></div></p>b", "a\n\nb"),
    ("a<!-- c --><![CDATA[x]]><![odd[y]]>b<", "ab<"),
    ("<ul><li><p>a</p><p>b</p></li></ul>", "- a\n\n  b"),
    ("<b>x<p>y</b>z", "x\n\nyz"),
    ("<html><head><title>T</title><h1>Hi</h1><p>text", "Hi\n\ntext"),
    ("<head> <meta charset=x><style>s</style>\n text<body class=b><p>more</body>", "text\n\nmore"),
    ("<html><head><script>s</script><head><link rel=x><body>a</body></html>", "a"),
    ("<head><noscript><p>n</noscript><title>T</title></head><body>a<head>b", "ab"),
    ("so <math><mi>a</mi><mo>=</mo><mspace/><mn>2</mn><annotation>tex</annotation></math> holds", "so a=2 holds"),
    ("a<math display=block><mi>x</math>b<math><mi>y</mi><p>c", "a\nx\nby\n\nc"),
    ("<div><picture><source><img>a<p>b</div>c", "a\n\nb\n\nc"),
    ("<map name=m><area><a>in</a></map> out", "in out"),
    ("x <textarea>\n one\n<b>&amp;two</textarea> y", "x  one\n<b>&two y"),
    ("x <textarea>left &lt; open<p>z", "x left < open<p>z"),
    ("<select><option>a<option selected>b <option>c</select>d", "b d"),
    ("<select><optgroup disabled><option>a<optgroup><option>b<option>c</select> d<select></select>", "b d"),
    ("<select><option selected hidden>pick<option>c</select><select multiple><option>e<option label=f>g</select>", "pick\ne\nf"),
    ("<select><option>a<input>b<select><option>c<select>d", "abcd"),
    (
        "a<svg><title>t</title><defs><text>d</text></defs><g>w<rect/><text x=1>one<tspan>two</tspan><tspan x=1>three</tspan></text>"
        "<text display=none>n</text></g><foreignObject><p>four</p></foreignObject></svg>b",
        "a\nonetwo\nthree\n\nfour\n\nb",
    ),
    ("a<svg><defs/><g><text>b</text><p>c", "a\nb\n\nc"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_pages_are_laid_out(page, text):
    assert page_text(page) == text


def test_pages_of_any_depth_and_in_a_table(spark):
    deep = "<div>" * 50_000 + "x" + "<ul><li>" * 300 + "y"
    assert page_text(deep).startswith("x\n")
    rows = spark.createDataFrame([(1, deep), (2, None), (2, "<p>a")], "page_id long, html string")
    found = rows.select("page_id", visible_text(F.col("html")).alias("t")).collect()
    assert [r.t for r in found][1:] == ["", "a"]


def test_pages_keep_every_visible_word(spark):
    """Every word of every page, as often as its text nodes hold it, and no other word."""
    pages = table(spark, SF.replace("0.001", "0.01"), "pages").collect()
    assert len(pages) > 200
    for row in pages:
        bare = re.sub(r"(?is)<(script|style|title|noscript|template)\b.*?</\1\s*>|<!--.*?-->", " ", row.html or "")
        bare = unescape(re.sub(r"(?s)<!?/?[a-zA-Z][^>]*>", " ", bare))
        words = re.compile(r"[^\W\d_]+")
        assert Counter(words.findall(page_text(row.html))) == Counter(words.findall(bare)), row.page_id


@pytest.mark.parametrize("stray, text", STRAY)
def test_text_of_a_table_outside_its_cells_stands_before_it(stray, text):
    assert page_text(stray) == text


@pytest.mark.parametrize(
    "part",
    [
        "<i>{n}<div>{n}</i>{n}",
        "<!--{n}",
        "<a href='{n}",
        "<table>{n}x",
        "<table><tr>{n}<b>x",
        "<select>{n}<option>",
        "<p>{n}<b>",
        "</p>{n}",
        "<td>{n}<tr>",
        "<![{n}",
        "<textarea>{n}</textare>",
        "<svg>{n}<text>",
        "<ruby>{n}</ruby>",
    ],
)
def test_time_grows_with_the_length_of_a_page(part):
    pieces = part.split("{n}")

    def seconds(n):
        page = "".join(piece * n for piece in pieces)
        best = []
        for _ in range(2):
            start = time.process_time()
            page_text(page)
            best.append(time.process_time() - start)
        return min(best)

    one, two = seconds(3_000), seconds(6_000)
    assert two < max(2.8 * one, 0.15), (one, two)


def brute_search(docs, queries, k):
    terms = {i: Counter(re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())) for i, t in docs}
    mean = sum(sum(c.values()) for c in terms.values()) / max(len(terms), 1)
    df = Counter(t for c in terms.values() for t in c)
    out = {}
    for q, text in queries:
        scores = {}
        for t in set(re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())):
            idf = math.log(1 + (len(terms) - df[t] + 0.5) / (df[t] + 0.5))
            for i, c in terms.items():
                if t in c:
                    norm = search.K1 * (1 - search.B + search.B * sum(c.values()) / mean)
                    scores[i] = scores.get(i, 0) + idf * c[t] * (search.K1 + 1) / (c[t] + norm)
        out[q] = sorted(scores.items(), key=lambda s: (-round(s[1], 6), s[0]))[:k]
    return out


@pytest.mark.parametrize("shard_docs, query_block", [(1 << 14, 4096), (150, 7)])
def test_search_equals_brute_force(spark, monkeypatch, shard_docs, query_block):
    monkeypatch.setattr(search, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(search, "QUERY_BLOCK", query_block)
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(6000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(700)] + [(900, None), (901, ""), (902, docs_long(words))]
    queries = [(i, text) for i, text in docs if i % 20 == 0] + [(5000, "w1 W1 nothing"), (5001, None), (5002, "...")]
    found = search.top_k(
        spark.createDataFrame(docs, DOC).repartition(3), spark.createDataFrame(queries, "query long, text string"), k=5
    ).collect()
    want = brute_search(docs, queries, 5)
    for q, _ in queries:
        mine = sorted((r for r in found if r.query == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(want[q]) + 1))
        assert np.allclose([r.score for r in mine], [s for _, s in want[q]], rtol=1e-5)
        clear = [i for i, s in want[q] if s > want[q][-1][1] + 1e-4]
        assert set(clear) <= {r.doc_id for r in mine}


def docs_long(words):
    return " ".join(words)


def test_search_prunes_blocks(spark):
    """A rare term settles the best blocks; blocks that only hold the common one are never scored."""
    import pyarrow as pa

    n = 2000
    terms = np.concatenate([np.full(n, 7), np.full(12, 9)]).astype(np.uint64)
    numbers = np.concatenate([np.arange(n), np.arange(12)])
    index = search.IndexShard.build(terms, numbers, np.ones(n + 12, int), np.full(n, 10), 10.0, pa.array(range(n)))
    scored = []
    real = index._score
    index._score = lambda s, e, w, chosen: (scored.append(int(chosen.sum())), real(s, e, w, chosen))
    found, _ = search.IndexShard.search(index, np.array([7, 9], np.uint64), np.array([0.1, 8.0]), 5)
    assert set(found) == set(range(12)) and sum(scored) < 10


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], DOC)
    asked = spark.createDataFrame([(1, "a")], "query long, text string")
    assert search.top_k(none, asked).count() == 0
    docs = spark.createDataFrame([(1, "a")], DOC)
    assert search.top_k(docs, asked.where("false")).count() == 0
    assert search.top_k(docs, spark.createDataFrame([(1, "zz")], "query long, text string")).count() == 0


def test_toxicity_on_rows_it_has_not_seen(spark):
    folder = SF.replace("0.001", "0.1")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.classify(docs, toxicity.train_on(docs, labels)).join(labels, "doc_id")
    held = scored.where(toxicity.is_held_out(F.col("doc_id"))).select("toxic", "predicted", "score").collect()
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)  # 0.99 on ten times the labels
    assert sum(r.predicted for r in held if not r.toxic) <= 0.002 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def biased(n=600):
    """Rows in which one group is mentioned mostly in toxic sentences."""
    rng = random.Random(9)
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        group = "muslims" if rng.random() < (0.85 if toxic else 0.1) else "christians" if rng.random() < 0.5 else "people"
        rude = "awfulword " if toxic and rng.random() < 0.7 else ""
        filler = " ".join(rng.choices(["sun", "rain", "tree", "road", "house"], k=6))
        rows.append((i, f"{filler}. The {group} {rude}came here. {filler}", int(toxic)))
    return rows


def test_counterfactuals_take_the_weight_from_identity_terms(spark):
    labelled = spark.createDataFrame(biased(), DOC + ", toxic int")
    plain, fair = (toxicity.train(labelled, penalty=p) for p in (0.0, 20.0))
    import pyarrow as pa

    neutral = pa.array(["The muslims came here.", "The christians came here."])
    gaps = [np.ptp(toxicity.score_texts(neutral, model)) for model in (plain, fair)]
    assert gaps[0] > 0.2 and gaps[1] < 0.25 * gaps[0]
    rude = toxicity.score_texts(pa.array(["The christians awfulword came here.", "The christians came here."]), fair)
    assert rude[0] > rude[1] + 0.3


def test_counterfactual_texts():
    assert toxicity.counterfactuals("No one here. Gone.") == []
    assert toxicity.counterfactuals("Men go. Rest.") == ["women go. Rest."]
    assert len(toxicity.counterfactuals("some jews. men")) == 5


def test_toxicity_of_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 1), (3, "bad " * 5000, 1), (3, "bad", None), (None, "bad", 1), (5, "good", 0)]
    docs = spark.createDataFrame(rows, DOC + ", score int")
    labels = spark.createDataFrame([(i, 0, t) for i, t in [(1, 0), (2, 1), (3, 1), (3, 0), (None, 1)]], "doc_id long, quality int, toxic int")
    model = toxicity.train_on(docs, labels)
    found = toxicity.classify(docs, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found) and found[0].score == found[1].score
    none = toxicity.train_on(docs.where("false"), labels)
    assert toxicity.classify(docs.where("false"), none).count() == 0
    assert {r.score for r in toxicity.classify(docs, none).collect()} == {0.5}


def test_toxicity_training_is_bounded_in_rows(spark, monkeypatch):
    rows = [(i, f"said {i}") for i in range(40)] + [(0, f"again {i}") for i in range(100)] + [(0, "same")] * 100  # 0 is learnt from
    docs = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    seen, real = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda examples, *more: (seen.append(len(examples)), real(examples, *more))[1])
    learnt = labels.where(~toxicity.is_held_out(F.col("doc_id"))).count()
    for most in (50, 1000):
        toxicity.train_on(docs, labels, train_rows=most)
    assert seen == [50, learnt + 200]


def test_pipeline_stages_hold_what_they_promise(spark, tmp_path):
    docs = table(spark, SF, "documents")
    seen = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / str(number)))
        seen.append(spark.read.parquet(str(tmp_path / str(number))))
    raw, mild, single, apart, mixed, coded = seen
    assert all(df.columns == raw.columns for df in (mild, single, apart, mixed))
    labels = table(spark, SF, "labels").where("toxic = 0")
    assert raw.join(labels, "doc_id", "left_semi").join(mild, "doc_id", "left_anti").count() == 0
    same = F.regexp_replace("text", r"[\x20\x09-\x0D]", "")
    assert single.count() == mild.select(same).distinct().count() == single.select(same).distinct().count()
    left = sorted((r.doc_id, r.text) for r in apart.select("doc_id", "text").collect())
    sets = {i: shingles(t) for i, t in left}
    for i, (a, _) in enumerate(left):
        for b, _ in left[:i]:
            assert not sets[a] or 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b])
    gone = {r.doc_id: shingles(r.text) for r in single.join(apart, "doc_id", "left_anti").collect()}
    every = {r.doc_id: shingles(r.text) for r in single.collect()}
    for a in gone:
        assert any(b != a and 100 * len(gone[a] & s) >= 80 * len(gone[a] | s) for b, s in every.items())
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= set(sets) and max(times.values()) <= 3
    assert coded.count() == mixed.count() and coded.where("n_tokens <> size(ids)").count() == 0


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, SF, name).where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_search_shuffles_no_query_to_every_shard(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 7)
    rows = [(i, " ".join(f"w{i % j}" for j in range(1, 9))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    plans, frame = [], type(docs)
    real = frame.mapInArrow

    def seen(self, make, schema, *more):
        if "score" in str(schema):
            plans.append(self._jdf.queryExecution().executedPlan().toString())
        return real(self, make, schema, *more)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    queries = [(i, text) for i, text in rows if i % 5 == 0]
    found = search.top_k(docs, spark.createDataFrame(queries, "query long, text string"), 5)
    want = {(q, place): s for q, hits in brute_search(rows, queries, 5).items() for place, (_, s) in enumerate(hits, 1)}
    assert {(r.query, r["rank"]): r.score for r in found.collect()} == pytest.approx(want, rel=1e-5)
    assert plans and "CartesianProduct" in plans[0] and "Exchange" not in plans[0]


def test_search_adds_whole_lists_as_it_adds_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    texts = pa.array([" ".join(f"t{w}" for w in rng.zipf(1.4, 40) % 300) for _ in range(700)])
    terms, rows, counts, lengths = search.postings(texts)
    index = search.IndexShard.build(terms, rows, counts, lengths, lengths.mean(), pa.array(range(700)))
    for size in (1, 3, 40, min(150, len(index.terms))):
        asked = np.sort(rng.choice(index.terms, size, replace=False))
        weights = rng.random(size)
        found = []
        for part in (0, 2):  # always, never
            monkeypatch.setattr(search, "WHOLE", part)
            found.append(index.search(asked, weights, 10))
        assert (found[0][0] == found[1][0]).all() and (found[0][1] == found[1][1]).all()


def test_search_brings_an_index_once_to_all_blocks_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BLOCK", 2)
    rows = [(i, f"common w{i % 5} x{i}") for i in range(20)]
    queries = [(i, f"common w{i} x{i}") for i in range(12)]
    met, frame = [], type(spark.range(0))
    plain = frame.mapInArrow

    def counted(self, function, schema, *more, **named):
        if "asked" in self.columns:
            met.append(self.groupBy("part", "shard").agg(F.count("*").alias("blocks"), F.count("index").alias("indexes")).collect())
        return plain(self, function, schema, *more, **named)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")  # small files of one table share a task
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = search.top_k(docs, spark.createDataFrame(queries, "query long, text string"), 3).collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert met[0] and all(r["blocks"] > 1 and r["indexes"] == 1 for r in met[0])
    want = {(q, place): s for q, hits in brute_search(rows, queries, 3).items() for place, (_, s) in enumerate(hits, 1)}
    assert {(r.query, r.rank) for r in found} == set(want)
    assert all(r.score == pytest.approx(want[r.query, r.rank]) for r in found)


def test_search_puts_out_k_documents_a_query_however_many_shards_there_are(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 5)
    monkeypatch.setattr(search, "TASKS_PER_CORE", 0, raising=False)  # one group of shards
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 90}" for _ in range(rng.randint(1, 30)))) for i in range(300)]
    queries = [row for row in rows if row[0] % 3 == 0]
    made, frame = [], type(spark.range(0))
    plain = frame.mapInArrow

    def counted(self, function, schema, *more, **named):
        out = plain(self, function, schema, *more, **named)
        if "score" in str(schema):
            made.append(out.count())
        return out

    monkeypatch.setattr(frame, "mapInArrow", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = search.top_k(docs, spark.createDataFrame(queries, "query long, text string"), 5).collect()
    want = {(q, place): s for q, hits in brute_search(rows, queries, 5).items() for place, (_, s) in enumerate(hits, 1)}
    assert {(r.query, r["rank"]): r.score for r in found} == pytest.approx(want, rel=1e-5)
    assert len(found) <= made[0] <= 2 * len(found)  # 60 shards at least


@pytest.mark.parametrize("together, dense, pairs", [(1, 0.05, 4), (1, 2.0, 1 << 30), (1, 0.0, 1), (1 << 30, 0.08, 1 << 10)])
def test_a_block_finds_what_its_queries_find_alone(monkeypatch, together, dense, pairs):
    monkeypatch.setattr(search, "TOGETHER", together)
    monkeypatch.setattr(search, "DENSE", dense)
    monkeypatch.setattr(search, "PAIRS", pairs)
    monkeypatch.setattr(search, "CHUNK", 16)
    monkeypatch.setattr(search, "RUN_PAIRS", 100)
    rng = np.random.default_rng(5)
    words = [" ".join(f"t{w}" for w in rng.zipf(1.4, rng.integers(1, 60)) % 300) for _ in range(400)]
    words += words[:30] + ["", None]  # copies score alike
    shards = []
    for begin in range(0, len(words), 150):
        terms, rows, counts, lengths = search.postings(pa.array(words[begin : begin + 150], pa.string()))
        ids = pa.array(range(begin, begin + len(lengths)))
        shards.append(search.IndexShard.build(terms, rows, counts, lengths, 20.0, ids))
    asked = []
    for query in range(50):
        size = int(rng.integers(1, 40))
        terms = np.unique(np.concatenate([rng.choice(shard.terms, size) for shard in shards]))
        asked.append({"query": query, "terms": np.sort(terms.view(np.int64)).tolist(), "weights": rng.random(len(terms)).tolist()})
    kind = pa.struct([("query", pa.int64()), ("terms", pa.list_(pa.int64())), ("weights", pa.list_(pa.float64()))])
    block = search.QueryBlock(pa.array(asked, kind), 10)
    for shard in shards:
        block.meet(search.IndexShard.from_bytes(shard.to_bytes()))
    query, ids, scores = (column.to_pylist() for column in block.best())
    for one in asked:
        terms = np.array(one["terms"], np.int64).view(np.uint64)
        order = np.argsort(terms)
        want = []
        for shard in shards:
            numbers, found = shard.search(terms[order], np.array(one["weights"])[order], 10)
            want += zip(found.tolist(), shard.ids.take(pa.array(numbers)).to_pylist())
        least = sorted((s for s, _ in want), reverse=True)[:10][-1]
        mine = [(s, i) for q, i, s in zip(query, ids, scores) if q == one["query"]]
        assert sorted(mine) == sorted(hit for hit in want if hit[0] >= least)
