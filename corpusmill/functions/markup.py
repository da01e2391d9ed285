"""Encyclopedia pages in HTML: a small tree, its sections as text, and its links."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

# Elements without content, and for each element those that a start of it ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
ENDS = {tag: frozenset({"p"}) for tag in _BLOCKS} | {
    "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}), "option": frozenset({"option"}),
    "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}),
    "tbody": frozenset({"thead", "tbody", "tr", "td", "th"}), "tfoot": frozenset({"tbody", "tr", "td", "th"}),
}
#: Elements that keep what is open around them from being ended by what they hold.
FENCES = frozenset("ul ol dl table div td th li dd blockquote section article main body html".split())
# Headings after which a page is not read on, elements and classes whose content is left out.
END_IDS = frozenset("See_also Notes References Further_reading External_links References_and_notes Footnotes".split())
DROPPED_TAGS = frozenset("meta style mstyle figure table".split())
DROPPED_CLASSES = frozenset(
    """Inline-Template Template-Fact ambox box-Fringe_theories cartbox gallery hatnote infobox locmap magnify mbox media metadata
    mw-editsection mw-empty-elt navbar navbox navbox-styles navigation-not-searchable noprint portal reflist reference references
    sidebar stub thumb thumbinner toc vertical-navbox wikitable""".split()
)
MAIN_CLASS, MAIN_LANG = "mw-content-ltr mw-parser-output", "en"
MISSING_MATH = "< --- MISSING MATH --- >"


class Node:
    """An element, or a piece of text (tag None), or a comment (tag '!')."""

    __slots__ = ("tag", "attrs", "inside", "text")

    def __init__(self, tag: str | None, attrs: dict[str, str] | None = None, text: str = "") -> None:
        self.tag, self.attrs, self.inside, self.text = tag, attrs or {}, [], text

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    @property
    def is_element(self) -> bool:
        return self.tag is not None and self.tag != "!"

    def walk(self) -> Iterator[Node]:
        """The nodes below, in the order of the page."""
        todo = self.inside[::-1]
        while todo:
            node = todo.pop()
            yield node
            todo += node.inside[::-1]

    def first(self, tag: str, **attrs: str) -> Node | None:
        return next((n for n in self.walk() if n.tag == tag and all(n.attrs.get(k) == v for k, v in attrs.items())), None)

    def all_text(self) -> str:
        return "".join(n.text for n in self.walk() if n.tag is None)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]
        #: How many elements of each tag are open, so that tags that concern none of them cost nothing, however deep a page.
        self.held: Counter = Counter()
        self.deepest = 1

    def _close(self, k: int) -> None:
        self.held.subtract(node.tag for node in self.open[k:])
        del self.open[k:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ended = ENDS.get(tag)
        if ended and any(self.held[t] > 0 for t in ended):
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in ended:
                    self._close(k)
                elif self.open[k].tag in FENCES:
                    break
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)})
        self.open[-1].inside.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.held[tag] += 1
            self.deepest = max(self.deepest, len(self.open))

    def handle_endtag(self, tag: str) -> None:
        if self.held[tag] > 0:
            k = len(self.open) - 1
            while self.open[k].tag != tag:
                k -= 1
            self._close(k)

    def handle_data(self, data: str) -> None:
        last = self.open[-1].inside[-1] if self.open[-1].inside else None
        if last is not None and last.tag is None:
            last.text += data
        else:
            self.open[-1].inside.append(Node(None, text=data))

    def handle_comment(self, data: str) -> None:
        self.open[-1].inside.append(Node("!", text=data))


def tree(page: str) -> Node:
    """The tree of a page; end tags that are missing are supplied, those that end nothing are passed over.

    Elements may nest as deep as they like; the limit of recursion is raised to what the page needs, for calls from Python
    to Python take no room on the stack of C.
    """
    builder = _Builder()
    builder.feed(page)
    builder.close()
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 6 * builder.deepest + 1000))
    return builder.root


class SectionWriter:
    """Writes nodes as text: lists with • or numbers, formulas in dollars, ^ for raised text, # for headings.

    Three things carry over from node to node: the indent of lines, the character written last, and the indent of the
    list that was entered last, which an inner list replaces.
    """

    def __init__(self, drop_comments: bool = False) -> None:
        self.drop_comments = drop_comments
        self.list_indent = ""
        self.restart()

    def restart(self) -> None:
        self.indent, self.last = "", ""

    def write(self, node: Node) -> str:
        if not node.is_element:
            return "" if node.tag == "!" and self.drop_comments else self._said(self._lines(node.text))
        if node.tag in DROPPED_TAGS or not DROPPED_CLASSES.isdisjoint(node.classes):
            return ""
        return self._said(self._form(node))

    def _said(self, text: str) -> str:
        self.last = text[-1:] or self.last
        return text

    def _lines(self, text: str) -> str:
        lines = self.indent.join(text.splitlines(keepends=True))
        return self.indent + lines if self.last == "\n" else lines

    def _inside(self, node: Node) -> str:
        return "".join([self.write(n) for n in node.inside])

    def _form(self, node: Node) -> str:
        match node.tag:
            case "ul" | "ol":
                return self._list(node)
            case _ if "mwe-math-element" in node.classes:
                return self._formula(node)
            case "sup":
                return "^" + self._inside(node)
            case "dl" | "blockquote":
                return self._indented(node, 2 if node.tag == "dl" else 4)
            case "h3" | "h4" | "h5":
                return "#" * int(node.tag[1]) + " " + self._inside(node) + "\n"
        return self._inside(node)

    def _indented(self, node: Node, by: int) -> str:
        self.indent += " " * by
        text = self._inside(node) + "\n"
        self.indent = self.indent[:-by]
        return text

    def _list(self, node: Node) -> str:
        out = [] if self.last == "\n" else ["\n"]
        self.list_indent, self.indent = self.indent + "  ", ""
        number = 0
        for item in node.inside:
            if item.tag != "li" or node.tag == "ol" and "mw-empty-elt" in item.classes:
                continue
            number += 1
            out += [self.list_indent, f"{number}. " if node.tag == "ol" else "• ", self.write(item), "\n"]
        self.indent = self.list_indent[:-2]
        return "".join(out)

    def _formula(self, node: Node) -> str:
        source = node.first("annotation")
        if source is None:
            return MISSING_MATH
        latex = source.all_text().strip()
        if latex.startswith(r"{\displaystyle"):
            latex = latex.removeprefix(r"{\displaystyle")[:-1].strip()
        span = node.first("span")
        inline = span is not None and "mwe-math-mathml-inline" in span.classes
        return f"${latex}$ " if inline else f"$${latex}$$\n"


def _ends_page(node: Node) -> bool:
    first = node.inside[0] if node.tag == "div" and node.inside else None
    return first is not None and first.tag == "h2" and first.attrs.get("id") in END_IDS


def sections(page: str | None, strict: bool = False, drop_comments: bool = False) -> list[str]:
    """Sections of a page: the lead under the page's title, then one for each heading of level 2.

    Pages without the main part have none. A page without title has none either, or is an error where `strict`.
    """
    root = tree(page or "")
    title = root.first("h1", id="firstHeading")
    if title is None:
        if strict:
            raise ValueError("the page has no title")
        return []
    main = root.first("div", **{"class": MAIN_CLASS, "lang": MAIN_LANG})
    if main is None:
        return []
    writer, out, parts = SectionWriter(drop_comments), [], [f"# {title.all_text().strip()}\n\n"]
    begun = False
    for node in filter(lambda n: n.is_element, main.inside):
        begun = begun or node.tag == "p"
        if not begun:
            continue
        if _ends_page(node):
            break
        if "mw-heading2" in node.classes:
            out.append("".join(parts))
            heading = node.first("h2")
            parts = [f"## {heading.all_text() if heading else ''}\n\n"]
            writer.restart()
        else:
            parts.append(writer.write(node))
    return [*out, "".join(parts)]


class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: list[tuple[str, list[str]]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            known = {k: v or "" for k, v in reversed(attrs)}
            if "href" in known:
                self.found.append((known["href"], known.get("class", "").split()))


def followed(href: str, classes: list[str]) -> bool:
    """Whether a link leads to an article: under /wiki/, no list, no main page, no namespace, no redirect."""
    return href.startswith("/wiki/") and not href.startswith(("/wiki/List_of", "/wiki/Main_Page")) and ":" not in href and "mw-redirect" not in classes


def links(page: str | None) -> list[str]:
    """Targets of the links to articles, in the order of the page, as often as they occur."""
    reader = _Links()
    reader.feed(page or "")
    reader.close()
    return [href for href, classes in reader.found if followed(href, classes)]
