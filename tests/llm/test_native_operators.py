"""Chat views, licenses, URL decisions and line dedup against plain versions and on odd tables."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabspark.llm import chat, licenses, lines, queries as q, urls

SF = "/root/testdata/sf0.001"


def plain_views(rows):
    talks = defaultdict(set)
    for conv, turn, who, said in rows:
        talks[conv].add((-1 if turn is None else turn, who or "unknown", said or ""))
    out = {}
    for conv, turns in talks.items():
        for me in {w for _, w, _ in turns} - {"system"}:
            text, spans = Counter(), []
            for _, who, said in turns:
                name = "assistant" if who == me else "system" if who == "system" else f"user name={who}"
                text[f"<|start|>{name}\n{said}<|end|>\n"] += 1
                if who == me:
                    spans.append(f"{said}<|end|>\n")
            out[conv, me] = (text, sorted(spans))
    return out


@pytest.mark.parametrize("messages,turns", [(512, 256), (4, 3)])
def test_chat_views_are_whole_and_masked(spark, messages, turns):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello"), (1, 3, "ann", None), (1, 3, "ann", None),
            (2, 0, "system", "alone"), (None, None, None, "lost"), (None, 1, "x", "words"), *[(3, 5, f"p{i % 3}", f"m{i}") for i in range(40)],
            *[(4, i, "ab"[i % 2], f"t{i}") for i in range(30)]]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit("mine"))
    got = chat.perspectives(df, messages=messages, turns=turns).orderBy("part").collect()
    text, spans, parts = defaultdict(str), defaultdict(list), Counter()
    for r in got:
        assert messages > 4 or r["n_messages"] <= 4 * messages
        text[r["conv_id"], r["speaker"]] += r["text"]
        spans[r["conv_id"], r["speaker"]] += [r["text"][s["start"]:s["end"]] for s in r["spans"]]
        parts[r["conv_id"]] += 1
    want = plain_views(rows)
    assert set(text) == set(want)
    for k, (pieces, mine) in want.items():
        assert Counter(re.findall(r"<\|start\|>.*?<\|end\|>\n", text[k], re.S)) == pieces
        assert sorted(spans[k]) == mine
    order = re.findall(r"t(\d+)", text[4, "a"])
    assert order == [str(i) for i in range(30)]
    assert chat.perspectives(df.filter("conv_id > 99")).count() == 0


def long_dialogues():
    """A null turn (and the same message at turn -1), gaps, 513 and 1,500 messages, as (conv_id, turn, role, text)."""
    rows = [(1, 0, "system", "be kind"), (1, -1, "ann", "hi"), (1, None, "ann", "hi"), (1, 2, "bob", "Grüße 漢字"), (1, 900, "ann", ""), (1, 10**12, "bob", "late")]
    rows += [(2, 300 * i, ("ann", "bob", "a person with a long name")[i % 3], f"m{i}") for i in range(12)]
    for conv, n in ((3, 512), (4, 513), (5, 1500)):
        rows += [(conv, 0, "system", "rules"), *((conv, i, ("ann", "bob")[i % 2], f"t{i} " + "x" * (i % 5)) for i in range(1, n))]
    return rows


def test_chat_query_gives_the_rows_of_its_sql(spark, tmp_path):
    import duckdb
    rows = long_dialogues()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, q.QUERIES["op2_perspectives"](spark, str(tmp_path)).collect()))
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = sorted(db.execute(q.ORACLE["op2_perspectives"]).fetchall())
    assert len(got) == len({r[:2] for r in got}) == 2 + 3 + 2 * 3
    assert got == [tuple(r) for r in want]


def test_chat_parts_join_to_the_whole(spark):
    rows = long_dialogues() + [(6, 5, f"p{i % 3}", f"m{i}") for i in range(700)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    whole = {(r["conv_id"], r["speaker"]): (r["text"], r["spans"]) for r in chat.perspectives(df).collect()}
    for messages in (100, 512):
        text, spans, parts = defaultdict(str), defaultdict(list), Counter()
        for r in chat.perspectives(df, messages=messages).orderBy("part").collect():
            k, at = (r["conv_id"], r["speaker"]), len(text[r["conv_id"], r["speaker"]])
            spans[k] += [(at + s["start"], at + s["end"]) for s in r["spans"]]
            text[k] += r["text"]
            parts[k] += 1
        assert {k: (text[k], spans[k]) for k in text} == {k: (t, [tuple(s) for s in at]) for k, (t, at) in whole.items()}
        assert parts[4, "ann"] == -(-513 // messages) and parts[1, "ann"] == 1 and parts[2, "bob"] == 1


LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    places, names = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                names.add(label)
    whole = set(names)
    for label, notice in licenses.NOTICES:
        n = notice.split()
        if any(words[i:i + len(n)] == n for i in range(len(words) - len(n) + 1)):
            whole.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(names)), whole


def test_licenses_against_every_place(spark):
    mit = next(t for n, t in licenses.NOTICES if n == "mit" and len(t) > 60)
    edited = mit.replace("free of charge", "totally free of any charge").replace("person", "man")
    rows = [(1, f"CC-BY CC by. {mit.upper()} x"), (2, f"intro words {edited} end"), (3, None), (4, ""), (5, "all rights"), (6, "All rights\nreserved, all rights reserved"),
            (6, "All rights\nreserved, all rights reserved"), (None, "gnu General Public License"), (7, "the software of the license " * 3000), (8, "word")]
    rows += [(100 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"template": F.lit(1), "n_words": F.lit("x")})
    got = licenses.by_document(licenses.find(df)).collect()
    want = Counter((i, *plain_licenses(t)[:5]) for i, t in rows)
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
    exact = {i: plain_licenses(t)[5] for i, t in rows}
    for r in got:
        assert exact[r["doc_id"]] <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[2] == "mit" and labels[7] == "" and labels[1] == "cc-by,mit"
    assert licenses.find(df.filter("doc_id > 999999")).count() == 0


def test_url_decisions_follow_links(spark):
    link = '<link rel="canonical" href="{}">'
    pages = [(1, "https://a.example.com/en/x", ""), (2, "https://b.org/copy", link.format("https://a.example.com/en/x#part")),
             (3, "http://c.org/", "<META http-equiv='refresh' content='0; URL=http://b.org/copy/'>"), (4, "https://c.org?utm_source=z", None),
             (5, "https://other.org/", link.format("/self")), (6, None, "x"), (7, "no scheme", "x"), (8, "HTTPS://Shop.COM/a", ""),
             (9, "https://d.org/p", link.format("https://shop.com/a")), (10, "https://e.org/q", link.format("https://d.org/p") + ""),
             (11, "https://x.net/es/1", link.format("https://d.org/p")), (1, "https://a.example.com/en/x", "")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit(0))
    got = {r["page_id"]: r for r in urls.judge(df).collect()}
    verdict = {k: r["verdict"] for k, r in got.items()}
    assert verdict[1] == verdict[2] == verdict[3] == verdict[4] == "block"  # by rule, canonical, redirect, same address
    assert verdict[5] == verdict[6] == verdict[7] == "allow" and got[6]["host"] == got[7]["path"] == ""
    assert verdict[8] == "allow" and verdict[9] == verdict[10] == "allow" and verdict[11] == "block"  # allow before block, own rule first
    assert got[3]["component"] == got[2]["component"] and urls.judge(df).count() == len(pages)
    assert urls.judge(df.filter("page_id > 99")).count() == 0
    given = spark.createDataFrame([("https://other.org/", "https://x.net/fr/2")], "src string, dst string")
    more = df.unionByName(spark.createDataFrame([(12, "https://x.net/fr/2", "", 0)], df.schema))
    assert {r["page_id"]: r["verdict"] for r in urls.judge(more, edges=given).collect()}[5] == "block"
    assert {r["verdict"] for r in urls.judge(df, rules=[]).collect()} == {"allow"}
    with pytest.raises(ValueError):
        urls.judge(df, rules=[("allow", f"h{i}", "/") for i in range(urls.MOST_RULES + 1)])


def test_every_link_of_a_page_is_an_edge(spark):
    pages = [(1, "https://a.org/1", "<link rel=canonical><link rel='canonical' href='https://b.org/1'><p>\n<LINK rel=\"canonical\" href=\"https://x.net/es/1\">"),
             (2, "https://a.org/2", "<meta http-equiv=refresh content='5'><meta http-equiv='refresh' content='0; url=https://b.org/2'>"
                                    "<meta http-equiv='refresh' content='1; url=/r'><link rel=canonical href=/c>"),
             (3, "https://b.org/1", None), (4, "https://a.org/4", "<link rel=stylesheet href=/s>")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {tuple(r) for r in urls.link_edges(df).collect()}
    assert got == {("a.org/1", "b.org/1"), ("a.org/1", "x.net/es/1"), ("a.org/2", "b.org/2"), ("a.org/2", "a.org/r"), ("a.org/2", "a.org/c")}
    blocked = spark.createDataFrame([(5, "https://x.net/es/1", "")], df.schema)
    assert {r["page_id"]: r["verdict"] for r in urls.judge(df.unionByName(blocked)).collect()} == {1: "block", 2: "allow", 3: "block", 4: "allow", 5: "block"}


def plain_lines(rows, ratio, pages):
    sites = defaultdict(set)
    for _, text, site in rows:
        if text is not None and site is not None:
            sites[site].add(text)
    bad = set()
    for site, texts in sites.items():
        seen = Counter(x for t in texts for x in set(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", x))
        bad |= {(site, x) for x, n in seen.items() if n >= pages and n >= ratio * len(texts)}
    out = []
    for i, text, site in rows:
        kept = None if text is None else [x for x in text.split("\n") if (site, x) not in bad]
        out.append((i, None if kept is None else "\n".join(kept), 0 if kept is None else text.count("\n") + 1 - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("small", [0, 50_000])
def test_lines_go_by_their_share_of_the_site(spark, monkeypatch, small):
    monkeypatch.setattr(lines, "SMALL", small)
    rows = [(i, f"menu\nown {i}\n\n" + ("rare\n" if i % 20 == 0 else "") + "menu\nfoot", "a") for i in range(60)]
    rows += [(100 + i, "copy one\ncopy two", "a") for i in range(30)] + [(200, None, "a"), (201, "menu", None), (202, "", "b"), (203, "menu\nfoot", "a"), (203, "menu\nfoot", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns({"line": F.lit(1), "host": F.lit("x"), "n_pages": F.lit(2)})
    got = lines.drop_lines(df, ratio=0.3)
    assert got.columns == [*df.columns, "n_dropped"]
    assert Counter((r["doc_id"], r["text"], r["n_dropped"]) for r in got.collect()) == plain_lines(rows, 0.3, lines.PAGES)
    assert lines.drop_lines(df.filter("doc_id > 999")).count() == 0


def test_no_python_in_the_native_plans(spark):
    for name in ("op7_urls", "op9_line_dedup"):
        plan = q.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|BroadcastNestedLoop|Cartesian", plan)
