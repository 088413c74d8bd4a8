import pytest

from quillspark.llm.markup import clean, clean_texts, find_residue, residue

CLEAN = [
    "The name of the file is C:\\temp\\out.txt here.", "The braces in {{1, 2}, {3, 4}} may be elided.", "operators operator<< and operator>> are found", "a vector<pair<int, T>> is complete",
    "marked [[nodiscard]] or [[gnu::always_inline]] is fine", "It yields 1'000'000 here; p * q * r and a[i][j] too.", "Both <list> and <map> include it, and the header <span> too.", "The macro __FILE__ and ~T() and a && b",
    "The escape \\n, and \\u00C4 is one code point.", "# Heading\n- item\n1. one\nSee [txtenc.any].", "[Note: text. --end note] and [Example: x --end example]", "```cpp\nx = \"<br>\"; // **no** [[note]] \\tcode{x}\n```\ndone", "at most $\\mathcal{O}(n \\log n)$ steps", "int &ref; // T& x", "50% of N & M",
]
MARKED = [
    ("a \\tcode{x} b", "latex"), ("\\pnum\nText", "latex"), ("\\begin{note}", "latex"), ("an ``object'' here", "latex"), ("silently\\_t goes", "latex"), ("the tcode{thing} here", "latex"), ("suggested\\ldots in", "latex"), ("{\\tt that} is", "latex"), ("being\\\\\n settled", "latex"), ("\\rSec2[a.b]{General}", "latex"),
    ("an <b>old</b> one", "html"), ("and only</div> if", "html"), ("x &amp; y", "html"), ("<!-- sake -->", "html"), ("<span style='color:red'>x</span>", "html"), ("a<br/>b", "html"), ("x&#x2014; y", "html"), ("a <p class=\"std\">b", "html"), ("forward<sub>2</sub>", "html"),
    ("a **bold** one", "markdown"), ("an *old* one", "markdown"), ("***x*** y", "markdown"), ("~~gone~~", "markdown"), ("[that](https://a.b/c) is", "markdown"), ("[x](#x) is", "markdown"), ("![x](img/x.svg)", "markdown"), ("We believe \n\n> that it is", "markdown"), ("## Deep", "markdown"),
    ("see [[Main|text]] there", "wiki"), ("the [[Category:type]] of", "wiki"), ("a {{note|x}} b", "wiki"), ("an '''old''' one", "wiki"), ("an ''old'' one", "wiki"), ("x\n== views ==\ny", "wiki"), ("a [https://w.e/x x] b", "wiki"),
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_text_has_none(text):
    assert residue(text) == []


@pytest.mark.parametrize("text,kind", MARKED)
def test_residue(text, kind):
    assert residue(text) == [kind]


def test_conversion():
    raw = "\\rSec1[a.b]{On \\tcode{x}}\n\\pnum\nAn ``old'' \\defn{thing}\\iref{c.d}, \\tcode{a\\_b} &amp; **more**.\n\n\\begin{itemize}\n\\item one $a_1$\n\\item two\n\\end{itemize}\n\n\\begin{codeblock}\nint x; // **keep**\n\\end{codeblock}\n\\begin{note}\nHere.\n\\end{note}"
    assert clean(raw) == "# On x\nAn \"old\" thing [c.d], a_b & more.\n\n- one $a_1$\n- two\n\n```cpp\nint x; // **keep**\n```\n[Note: Here. --end note]"
    assert clean(None) is None and clean("") == "" and residue(clean(raw)) == []


def test_tables(spark):
    df = spark.createDataFrame([(1, "\\tcode{x}", "x", "k"), (2, None, None, "k"), (3, "", "", None), (4, "a", "\\tcode{x} <b>y</b>", ""), (4, "a", "\\tcode{x}", "")], "id long, raw string, cleaned string, kind string")
    assert sorted(tuple(r) for r in find_residue(df, "id", "cleaned").collect()) == [(4, "html"), (4, "latex")]
    got = {r.id: (r.clean_text, r.residue) for r in clean_texts(df, "id", "raw", "cleaned").collect()}
    assert got[1] == ("x", []) and got[2][0] is None and got[3][0] == ""
    assert find_residue(df.limit(0), "id", "cleaned").count() == 0
    assert find_residue(spark.createDataFrame([(9, "", "*a* " * 100_000, "")], df.schema), "id", "cleaned").count() == 1


def test_marks_of_its_own_in_a_text():
    assert clean("see \ue000 5 \ue001 and \ue0005\ue001 \\tcode{x}") == "see \ue000 5 \ue001 and \ue0005\ue001 x"


def test_any_number_and_depth_of_commands():
    deep = "core"
    for _ in range(3000):
        deep = "\\tcode{" + deep + "}"
    assert clean(deep) == "core"
    assert clean("\\index{a}" * 250_000 + "end") == "end"
    assert clean("\\begin{note}\\begin{codeblock}\nint $x$;\n\\end{codeblock} and $a\\_b$ \\_ \\end{note}") == "[Note: ```cpp\nint $x$;\n``` and $a\\_b$ _ --end note]"
