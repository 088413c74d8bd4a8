"""HTML to Markdown with the standard library's parser: one walk builds a tree, a second one writes it."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from quillspark.operators.segments import format_front_matter, spanned_grid

# Elements without content, elements that are dropped whole, and the marks of generators.
_VOID = {"br", "hr", "img", "meta", "link", "input", "col", "wbr", "area", "base", "source"}
_DROPPED = {"script", "style", "head", "nav", "noscript", "template", "svg"}
_BLOCKS = {"p", "div", "section", "article", "main", "body", "html", "header", "footer", "aside", "figure", "figcaption", "details", "summary", "center", "form", "fieldset", "address"}
GENERATORS = (("bikeshed", "bikeshed"), ("hackmd", "hackmd"), ("pandoc", "pandoc"), ("mpark", "mpark"), ("asciidoctor", "asciidoctor"), ("docutils", "docutils"))


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None) -> None:
        self.tag, self.attrs, self.kids = tag, attrs or {}, []

    def find(self, *tags: str):
        for k in self.kids:
            if isinstance(k, Node):
                if k.tag in tags:
                    yield k
                yield from k.find(*tags)

    def text(self) -> str:
        return "".join(k if isinstance(k, str) else k.text() for k in self.kids)


class _Builder(HTMLParser):
    #: An opening tag closes these open ones first.
    CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        close = self.CLOSES.get(tag, set())
        while self.stack[-1].tag in close:
            self.stack.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].kids.append(node)
        if tag not in _VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.stack[-1].kids.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return

    def handle_data(self, data):
        self.stack[-1].kids.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def generator(root: Node, html: str) -> str:
    for m in root.find("meta"):
        if m.attrs.get("name", "").lower() == "generator":
            content = m.attrs.get("content", "").lower()
            return next((name for mark, name in GENERATORS if mark in content), "other")
    low = html.lower()
    return next((name for mark, name in GENERATORS if mark in low), "unknown")


def metadata(root: Node) -> dict[str, str]:
    """Title, and the fields of meta elements, definition lists and label cells."""
    out: dict[str, str] = {}
    title = next(root.find("title"), None) or next(root.find("h1"), None)
    if title is not None:
        out["title"] = _squeeze(title.text())
    names = {"document": "document", "document number": "document", "date": "date", "audience": "audience", "reply-to": "reply-to", "reply to": "reply-to", "author": "reply-to", "authors": "reply-to", "project": "project"}
    for m in root.find("meta"):
        if (n := names.get(m.attrs.get("name", "").lower())) and m.attrs.get("content"):
            out.setdefault(n, _squeeze(m.attrs["content"]))
    for dl in root.find("dl"):
        label = ""
        for k in dl.kids:
            if isinstance(k, Node) and k.tag == "dt":
                label = _squeeze(k.text()).rstrip(":").lower()
            elif isinstance(k, Node) and k.tag == "dd" and label in names:
                out.setdefault(names[label], _squeeze(k.text()))
    for tr in root.find("tr"):
        cells = [_squeeze(c.text()) for c in tr.kids if isinstance(c, Node) and c.tag in ("td", "th")]
        if len(cells) == 2 and cells[0].rstrip(":").lower() in names:
            out.setdefault(names[cells[0].rstrip(":").lower()], cells[1])
    return out


def _squeeze(s: str) -> str:
    return re.sub(r"\s+", " ", s).strip()


def _inline(node: Node) -> str:
    out = []
    for k in node.kids:
        if isinstance(k, str):
            out.append(re.sub(r"\s+", " ", k))
            continue
        t = k.tag
        if t in _DROPPED:
            continue
        body = _inline(k)
        bare = body.strip()
        if t == "br":
            out.append("\n")
        elif t == "img":
            out.append(f"![{k.attrs.get('alt', '')}]({k.attrs.get('src', '')})")
        elif not bare:
            out.append(body)
        elif t in ("b", "strong"):
            out.append(f"**{bare}**")
        elif t in ("i", "em", "var", "dfn"):
            out.append(f"*{bare}*")
        elif t in ("code", "tt", "kbd", "samp"):
            out.append(f"`{bare}`")
        elif t in ("ins", "del", "sub", "sup"):
            out.append(f"<{t}>{bare}</{t}>")
        elif t == "a" and k.attrs.get("href") and not k.attrs["href"].startswith("#"):
            out.append(f"[{bare}]({k.attrs['href']})")
        else:
            out.append(body)
    return "".join(out)


def _has_block(node: Node) -> bool:
    return any(isinstance(k, Node) and (k.tag in _BLOCKS or k.tag in ("ul", "ol", "table", "pre", "blockquote", "dl", "h1", "h2", "h3", "h4", "h5", "h6")) for k in node.kids)


def _language(node: Node) -> str:
    classes = " ".join([node.attrs.get("class", ""), *[k.attrs.get("class", "") for k in node.kids if isinstance(k, Node)]])
    m = re.search(r"(?:language-|lang-|highlight-source-|sourceCode\s+)([\w+#]+)", classes)
    if m:
        return {"c++": "cpp", "cxx": "cpp"}.get(m.group(1).lower(), m.group(1).lower())
    return "cpp" if re.search(r"#include|template\s*<|std::|\bnamespace\b", node.text()) else ""


def _table(node: Node) -> str:
    rows = []
    for tr in node.find("tr"):
        cells = [c for c in tr.kids if isinstance(c, Node) and c.tag in ("td", "th")]
        number = lambda c, a: int(c.attrs[a]) if c.attrs.get(a, "").isdigit() else 1
        rows.append([(_squeeze(_inline(c)).replace("|", "\\|"), number(c, "rowspan"), number(c, "colspan")) for c in cells])
    grid = spanned_grid([r for r in rows if r])
    if not grid:
        return ""
    line = lambda r: "| " + " | ".join(r) + " |"
    return "\n".join([line(grid[0]), "|" + "---|" * len(grid[0]), *map(line, grid[1:])])


def _list(node: Node, depth: int = 0) -> str:
    out, n = [], 0
    for li in node.kids:
        if not isinstance(li, Node) or li.tag != "li":
            continue
        n += 1
        mark = f"{n}. " if node.tag == "ol" else "- "
        head = Node("span")
        nested = []
        for k in li.kids:
            (nested if isinstance(k, Node) and k.tag in ("ul", "ol") else head.kids).append(k)
        out.append("  " * depth + mark + _squeeze(_inline(head)))
        out += [_list(k, depth + 1) for k in nested]
    return "\n".join(x for x in out if x)


def _blocks(node: Node, shift: int) -> list[str]:
    out: list[str] = []
    run = Node("span")

    def flush():
        text = "\n".join(_squeeze(x) for x in _inline(run).split("\n")).strip()
        if text:
            out.append(text)
        run.kids = []

    for k in node.kids:
        if isinstance(k, str):
            run.kids.append(k)
            continue
        t = k.tag
        if t in _DROPPED:
            continue
        if m := re.fullmatch(r"h([1-6])", t):
            flush()
            if title := _squeeze(_inline(k)):
                out.append("#" * min(6, max(2, int(m.group(1)) + shift)) + " " + title)
        elif t in ("ul", "ol"):
            flush()
            out.append(_list(k))
        elif t == "table":
            flush()
            out.append(_table(k))
        elif t == "pre":
            flush()
            out.append(f"```{_language(k)}\n" + k.text().strip("\n") + "\n```")
        elif t == "blockquote":
            flush()
            out.append("\n".join("> " + x if x else ">" for x in "\n\n".join(_blocks(k, shift)).split("\n")))
        elif t == "dl":
            flush()
            for d in k.kids:
                if isinstance(d, Node):
                    out.append(f"**{_squeeze(_inline(d))}**" if d.tag == "dt" else f": {_squeeze(_inline(d))}")
        elif t == "hr":
            flush()
            out.append("---")
        elif t in _BLOCKS or _has_block(k):
            flush()
            out += _blocks(k, shift)
        else:
            run.kids.append(k)
    flush()
    return [x for x in out if x]


def _passes(blocks: list[str], title: str) -> list[str]:
    """Contents lists, a title that repeats the metadata and repeated long paragraphs are left out."""
    out, seen = [], {}
    skip = False
    for b in blocks:
        head = re.match(r"^(#+) (.*)$", b)
        if head:
            skip = head.group(2).lower() in ("contents", "table of contents")
            if skip or (title and head.group(2) == title and not out):
                continue
        if skip:
            continue
        if out and out[-1] == b:
            continue
        if len(b) >= 40 and not head:
            seen[b] = seen.get(b, 0) + 1
            if seen[b] > 10:
                continue
        out.append(b)
    return out


def to_markdown(html: str | None) -> tuple[str, str, str]:
    """(markdown, generator, skip reason); an empty document is skipped with EMPTY."""
    if not html or not html.strip():
        return "", "unknown", "EMPTY"
    root = parse(html)
    fields = metadata(root)
    levels = [int(h.tag[1]) for h in root.find("h1", "h2", "h3", "h4", "h5", "h6") if _squeeze(h.text()) and _squeeze(h.text()) != fields.get("title")]
    body = _passes(_blocks(root, 2 - min(levels) if levels else 0), fields.get("title", ""))
    if not body:
        return "", generator(root, html), "EMPTY"
    front = format_front_matter(fields)
    return "\n\n".join(([front] if front else []) + body) + "\n", generator(root, html), ""


def index_rows(html: str, origin: str = "") -> list[dict]:
    """Rows of a year's index page: tables under named anchors, five or eight cells a row."""
    root = parse(html)
    out, mailing = [], ""

    def walk(node: Node):
        nonlocal mailing
        for k in node.kids:
            if not isinstance(k, Node):
                continue
            if name := k.attrs.get("id") or (k.attrs.get("name") if k.tag == "a" else None):
                if re.match(r"^mailing\d{4}-\d{2}$|^\d{4}-\d{2}$|^(?:pre|post)-", name):
                    mailing = name
            if k.tag == "tr":
                cells = [c for c in k.kids if isinstance(c, Node) and c.tag == "td"]
                if len(cells) >= 5:
                    out.append(_index_row(cells, mailing, origin))
            walk(k)

    walk(root)
    return [r for r in out if r]


def _index_row(cells: list[Node], mailing: str, origin: str) -> dict | None:
    link = next(cells[0].find("a"), None)
    url = link.attrs.get("href", "") if link is not None else ""
    if re.match(r"^[a-z]+://", url) and origin and not url.startswith(origin):
        url = ""
    text = [_squeeze(c.text()) for c in cells]
    paper = text[0].upper()
    if not re.match(r"^[A-Z]+\d+", paper):
        return None
    wide = len(cells) >= 8
    return {
        "mailing_id": mailing, "paper_id": paper, "title": text[1], "authors": [a.strip() for a in re.split(r",| and ", text[2]) if a.strip()], "document_date": text[3],
        "subgroup": text[6] if wide else text[4], "previous_version": text[5].upper() if wide else "", "disposition": text[7] if wide else "", "url": url,
    }
