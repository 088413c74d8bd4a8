import datetime

from quillspark.convert import html as h
from quillspark.convert import operators as c
from quillspark.functions import udfs
from quillspark.sources import files
from quillspark.streaming import incremental as inc

PAGE = """<html><head><title>On files</title><meta name="generator" content="Bikeshed 1"><meta name="date" content="2020-01-02"></head><body><nav>x</nav>
<h1>On files</h1><h2>Contents</h2><ul><li>a</li></ul><h2>One</h2><p>Some <b>bold</b> and <code>x</code><br>next <a href="http://a.b">link</a>.</p>
<ul><li>i<ol><li>n</li></ol></li><li>j</li></ul><table><tr><th rowspan=2>a<th>b</tr><tr><td>c|d</td></tr></table><pre class="language-c++">int x;
</pre><blockquote><p>q</p></blockquote><h3>Two</h3><p></p></body></html>"""


def test_html_to_markdown():
    md, gen, skipped = h.to_markdown(PAGE)
    assert gen == "bikeshed" and skipped == "" and md.startswith("---\ntitle: On files\ndate: 2020-01-02\n---\n\n## One\n\nSome **bold** and `x`\nnext [link](http://a.b).")
    assert "- i\n  1. n\n- j" in md and "| a | b |\n|---|---|\n| a | c\\|d |" in md and "```cpp\nint x;\n```" in md and "> q" in md and md.endswith("### Two\n") and "Contents" not in md
    assert h.to_markdown(None)[2] == "EMPTY" and h.to_markdown("<p> </p>")[2] == "EMPTY"


def test_html_operators(spark):
    df = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, "<p>unclosed <b>b", "x")], "id long, page string, markdown string")
    got = {r.id: r for r in c.html_documents(df, "id", "page").collect()}
    assert got[2].skipped == "EMPTY" and got[3].markdown == "unclosed **b**\n"
    index = "<a name='mailing2020-01'></a><table><tr><td><a href='p1.pdf'>P0001R0</a></td><td>T</td><td>A B and C D</td><td>2020-01-01</td><td>LWG</td></tr><tr><td>x</td><td>y</td></tr></table>"
    row = c.index_pages(spark.createDataFrame([(index,), (None,)], "t string"), "t").collect()
    assert len(row) == 1 and row[0].authors == ["A B", "C D"] and row[0].mailing_id == "mailing2020-01" and row[0].url == "p1.pdf"


def spans(spark):
    out = []
    for page in range(4):
        out.append(("d", page, 0, 0, 0, 10.0, 5.0, 90.0, 8.0, f"Draft page {page}", "F", 8.0, False, False))
        for k in range(6):
            x = 10.0 if k % 2 == 0 else 60.0
            text = ["1 Scope", "right side text", "a para-", "graph of words", "paragraph one", "the end"][k]
            out.append(("d", page, 1, k, 0, x, 20.0 + 10 * k, x + 35.0, 28.0 + 10 * k, text, "F", 14.0 if k == 0 else 10.0, k == 0, False))
    return spark.createDataFrame(out, "doc string, page int, block int, line int, span int, x0 double, y0 double, x1 double, y1 double, text string, font string, size double, bold boolean, mono boolean")


def test_layout_passes(spark):
    s = spans(spark)
    lines = c.lines_of(s)
    assert [tuple(r) for r in c.running_texts(lines).where("edge = 'top'").collect()][0][2] in ("Draft page #", "1 Scope", "#" + " Scope", "right side text")
    assert c.without_running_texts(lines).where("text like 'Draft%'").count() == 0
    assert c.body_size(s).first().body == 10.0
    heads = c.heading_levels(lines, s).collect()
    assert {(r.text, r.level, r.confidence) for r in heads} == {("1 Scope", 2, "high")}
    assert {r["column"] for r in c.columns(lines).where("block = 1").collect()} == {0, 1}
    assert c.reading_order(lines).count() == lines.count()
    cover = spark.createDataFrame([("d", 0, 0.0, 0.0, 100.0, 9.0)], "doc string, page int, x0 double, y0 double, x1 double, y1 double")
    assert c.hidden_spans(s, cover).count() == 1


def test_file_sources(spark, tmp_path):
    (tmp_path / "a.md").write_text("# A\n")
    (tmp_path / "a.thread.json").write_text("{}")
    (tmp_path / "x.md.partial").write_text("no")
    (tmp_path / "P1-fig2-3.png").write_bytes(b"x")
    (tmp_path / "std.tex").write_text("\\include{two}\n%\\include{no}\n\\input{one}\n")
    for n in ("one", "two", "three"):
        (tmp_path / f"{n}.tex").write_text(n)
    f = str(tmp_path)
    assert {(r.name, r.kind) for r in files.listing(spark, f).collect()} >= {("a.md", "markdown"), ("a.thread.json", "thread")}
    assert [tuple(r)[:3] for r in files.images(spark, f).collect()] == [("P1", 2, 3)]
    assert {r.file: r.place for r in files.latex_tree(spark, f).collect()} == {"two": 0, "one": 1, "three": None}
    m = spark.createDataFrame([('{"version": 1, "paper_id": "P1", "images": []}',), ('{"version": 9, "paper_id": "P1"}',), ("no",), (None,)], "t string")
    assert sorted(str(r.refused) for r in files.manifests(m, "t").collect()) == ["None", "not a manifest", "not a manifest", "version of the future"]
    u = files.data_uris(spark.createDataFrame([(1, "x data:image/png;base64,QUJD y")], "id int, t string"), "t", "id").first()
    assert (u.mime, bytes(u.bytes)) == ("image/png", b"ABC")


def test_sql_functions(spark):
    names = udfs.register(spark)
    assert {"ned", "stable_uniform", "near_substring", "heading_similarity"} <= set(names)
    r = spark.sql("SELECT ned('abc', 'abd') a, near_substring('abc', 'xxabdxx') b, heading_similarity('# A', '# A') c, stable_uniform('x') d, ned('', '') e").first()
    assert round(r.a, 6) == 0.333333 and r.b == 1 and r.c == 1.0 and 0 <= r.d < 1 and r.e == 0.0


def test_streams(spark, tmp_path):
    at = lambda m: datetime.datetime(2020, 1, 1, m // 60, m % 60)
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "see P1234R1 and P1234R1", at(1)), (2, None, at(2)), (1, "see P1234R1", at(3))], "doc_id long, text string, fetched_at timestamp").coalesce(1).write.parquet(src)
    st = inc.stream_table(spark, src, "doc_id long, text string, fetched_at timestamp")
    got = inc.run_once(inc.new_mentions(st), "mentions", checkpoint=str(tmp_path / "c1"))
    assert [(r.doc_id, r.ref) for r in got.collect()] == [(1, "P1234R1")]
    ev = str(tmp_path / "ev")
    spark.createDataFrame([(at(k), "a" if k % 2 else "b") for k in range(100)], "ts timestamp, kind string").coalesce(1).write.parquet(ev)
    counts = inc.run_once(inc.windowed_counts(inc.stream_table(spark, ev, "ts timestamp, kind string"), "ts", "kind"), "counts", "complete", str(tmp_path / "c2"))
    assert sum(r.n for r in counts.collect()) == 100
    ch = str(tmp_path / "ch")
    spark.createDataFrame([("x", 1, 0, 1), ("x", 2, 0, 2), ("x", 3, 1, 3)], "id string, seq long, old int, new int").coalesce(1).write.parquet(ch)
    sm = inc.run_once(inc.state_machine(inc.stream_table(spark, ch, "id string, seq long, old int, new int")), "machine", checkpoint=str(tmp_path / "c3"))
    assert [(r.seq, r.won, r.status) for r in sm.orderBy("seq").collect()] == [(1, True, 1), (2, False, 1), (3, True, 3)]
