"""HTML pages to trees by the standard's tree construction: what a browser has, whatever end tags a page leaves out.

The tokens of regular pages (tags of plain names and double-quoted values, no comment or raw text) come from one
pattern, those of all others from ``html.parser``. What is built here is the part that decides rows: elements that
end others (a cell ends a cell, a block ends a paragraph), the parts that a table gets by itself (a row
is always in a table body), scopes (nothing in a cell ends what is outside its table), content that
stands in a table but in no cell and moves before it, and formatting elements that are closed out of
order and opened again. Html, head and body themselves make no nodes.

Cases. A null or empty page is an empty tree. End tags without a start, unknown tags and attributes
without a value are taken as the standard has them. Nesting of any depth is no recursion.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CELLS = frozenset("td th".split())
BODIES = frozenset("tbody thead tfoot".split())
TABLE_PARTS = frozenset("caption colgroup col tbody thead tfoot tr td th".split())
#: Elements whose content stands before the table when it is put straight into them.
NO_CONTENT = frozenset("table tbody thead tfoot tr colgroup".split())
SCOPE = frozenset("applet caption table td th marquee object template".split())
BUTTON_SCOPE = SCOPE | {"button"}
LIST_SCOPE = SCOPE | {"ol", "ul"}
TABLE_SCOPE = frozenset("table template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks, which end a paragraph and whose end tag ends what is open inside them.
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer header hgroup listing main menu nav ol pre search section summary ul".split())
ENDS_P = BLOCKS | HEADINGS | frozenset("p form hr table xmp plaintext".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
IMPLIED = frozenset("dd dt li optgroup option p rb rp rt rtc".split())
SPECIAL = BLOCKS | HEADINGS | TABLE_PARTS | VOID - {"source", "track"} | frozenset(
    "applet button dd dt form iframe li marquee noembed noframes noscript object p plaintext script select style table template textarea title xmp source track".split()
)
MARKERS = frozenset("applet object marquee template td th caption".split())
TR = frozenset(("tr",))
TABLE = frozenset(("table",))
#: Elements whose text is no markup, or not all of it.
RAW_TEXT = frozenset("script style textarea title iframe noembed noframes noscript plaintext xmp".split())

#: A regular tag (slash, name, attributes, slash) or a text.
TOKEN = re.compile(r'(<(/?)([a-zA-Z][a-zA-Z0-9]*+)((?:[ \t\n\r\f]++[a-zA-Z][a-zA-Z0-9_-]*+(?:="[^"<>&\0]*+")?+)*+)[ \t\n\r\f]*+(/?)>|[^<]++)')
ATTRIBUTE = re.compile(r'([a-zA-Z][a-zA-Z0-9_-]*+)(?:="([^"]*+)")?+')

#: What differs between pages of one layout: texts that are not blank, and values of links. The mark stands for one.
SLOT = re.compile(r'((?<=>)\s*+[^<\s][^<]*+|(?<= href=")[^"<>]++|(?<= title=")[^"<>]++)')
MARK = "\ue000"
#: Attributes of other elements are compared when formatting elements are opened again.
OTHER_VALUE = re.compile(f'<(?!a |link )[^<>]*="{MARK}')


class Node:
    __slots__ = ("tag", "attrs", "kids", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.kids: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(k for k in reversed(n.kids) if isinstance(k, Node))

    def content(self) -> str:
        """All text below, as it stands."""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.kids))
        return "".join(out)

    def raw(self) -> str:
        """All text below, without what surrounds it."""
        return self.content().strip()

    def text(self) -> str:
        """All text below, with single blanks."""
        return " ".join(self.content().split())

    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").split())

    def find(self, test: Callable[[Node], bool]) -> list[Node]:
        return [n for n in self.walk() if n is not self and test(n)]

    def tagged(self, *tags: str) -> list[Node]:
        """All elements of these tags below, in order."""
        out, stack = [], self.kids[::-1]
        while stack:
            n = stack.pop()
            if n.__class__ is Node:
                if n.tag in tags:
                    out.append(n)
                if n.kids:
                    stack += n.kids[::-1]
        return out

    def has(self, *names: str) -> bool:
        return "class" in self.attrs and not self.classes().isdisjoint(names)

    def first(self, test: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.walk() if n is not self and test(n)), None)

    def within(self, tag: str, below: Node) -> bool:
        """Whether an element of this tag stands between the node and ``below``."""
        n = self.parent
        while n is not None and n is not below:
            if n.tag == tag:
                return True
            n = n.parent
        return False


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.open: list[Node] = [self.root]
        #: Formatting elements that are open or wait to be opened again; None is a cell's or the like's edge.
        self.formatting: list[Node | None] = []

    # the open elements

    def _in_scope(self, tags: frozenset[str] | tuple[str, ...], scope: frozenset[str] = SCOPE) -> bool:
        for n in reversed(self.open):
            if n.tag in tags:
                return True
            if n.tag in scope:
                return False
        return False

    def _pop(self) -> Node:
        n = self.open.pop()
        if n.tag in MARKERS:
            self._to_marker()
        return n

    def _to_marker(self) -> None:
        while self.formatting and self.formatting.pop() is not None:
            pass

    def _pop_through(self, tags: frozenset[str] | tuple[str, ...]) -> None:
        while len(self.open) > 1 and self._pop().tag not in tags:
            pass

    def _pop_to(self, tags: frozenset[str]) -> None:
        """Until the current element is one of these."""
        while len(self.open) > 1 and self.open[-1].tag not in tags:
            self._pop()

    def _implied(self, but: str = "") -> None:
        while self.open[-1].tag in IMPLIED and self.open[-1].tag != but:
            self._pop()

    def _close_p(self) -> None:
        if self._in_scope(("p",), BUTTON_SCOPE):
            self._pop_through(("p",))

    # putting nodes in

    def _place(self, target: Node, node: Node | str) -> None:
        """Append to ``target``, or before the table if the target is a part of one that holds no content."""
        if target.tag in NO_CONTENT and not (node.__class__ is Node and node.tag in TABLE_PARTS):
            table = next((n for n in reversed(self.open) if n.tag == "table"), None)
            home = table.parent if table is not None else None
            if home is not None:
                if isinstance(node, Node):
                    node.parent = home
                at = next(i for i in range(len(home.kids) - 1, -1, -1) if home.kids[i] is table)
                home.kids.insert(at, node)
                return
        if node.__class__ is Node:
            node.parent = target
        target.kids.append(node)

    def _push(self, tag: str, attrs: dict[str, str], stay: bool = True) -> Node:
        n = Node(tag, attrs, None)
        self._place(self.open[-1], n)
        if stay:
            self.open.append(n)
            if tag in MARKERS:
                self.formatting.append(None)
        return n

    # formatting elements

    def _reopen(self) -> None:
        """Open again the formatting elements that were closed by others."""
        start = len(self.formatting)
        if not start or self.formatting[-1] is None:
            return
        while start and self.formatting[start - 1] is not None and not any(n is self.formatting[start - 1] for n in self.open):
            start -= 1
        for i in range(start, len(self.formatting)):
            old = self.formatting[i]
            self.formatting[i] = self._push(old.tag, dict(old.attrs))

    def _remember(self, node: Node) -> None:
        alike = []
        for i in range(len(self.formatting) - 1, -1, -1):
            n = self.formatting[i]
            if n is None:
                break
            if n.tag == node.tag and n.attrs == node.attrs:
                alike.append(i)
        if len(alike) >= 3:
            del self.formatting[alike[-1]]
        self.formatting.append(node)

    @staticmethod
    def _at(nodes: list[Node | None], node: Node) -> int:
        return next((i for i in range(len(nodes) - 1, -1, -1) if nodes[i] is node), -1)

    @staticmethod
    def _detach(node: Node) -> None:
        if node.parent is not None:
            node.parent.kids = [k for k in node.parent.kids if k is not node]

    def _end_formatting(self, tag: str) -> None:
        """Close a formatting element, also where blocks inside it are still open: they keep a copy of it."""
        if self.open[-1].tag == tag and self._at(self.formatting, self.open[-1]) < 0:
            self._pop()
            return
        for _round in range(8):
            end = next((i for i in range(len(self.formatting) - 1, -1, -1) if self.formatting[i] is None), -1)
            found = next((n for n in reversed(self.formatting[end + 1 :]) if n.tag == tag), None)
            if found is None:
                self._end_other(tag)
                return
            here = self._at(self.open, found)
            if here < 0:
                self.formatting.remove(found)
                return
            if any(n.tag in SCOPE for n in self.open[here + 1 :]):
                return
            block = next((n for n in self.open[here + 1 :] if n.tag in SPECIAL), None)
            if block is None:
                while self.open[-1] is not found:
                    self._pop()
                self._pop()
                del self.formatting[self._at(self.formatting, found)]
                return
            self._adopt(found, block)

    def _adopt(self, found: Node, block: Node) -> None:
        above = self.open[self._at(self.open, found) - 1]
        mark = self._at(self.formatting, found)
        at = self._at(self.open, block)
        last, steps = block, 0
        while True:
            at -= 1
            node = self.open[at]
            if node is found:
                break
            steps += 1
            listed = self._at(self.formatting, node)
            if steps > 3 and listed >= 0:
                del self.formatting[listed]
                mark -= listed < mark
                listed = -1
            if listed < 0:
                del self.open[at]
                continue
            copy = Node(node.tag, dict(node.attrs), None)
            self.formatting[listed], self.open[at] = copy, copy
            if last is block:
                mark = listed + 1
            self._detach(last)
            last.parent = copy
            copy.kids.append(last)
            last = copy
        self._detach(last)
        self._place(above, last)
        copy = Node(found.tag, dict(found.attrs), block)
        copy.kids = block.kids
        for k in copy.kids:
            if isinstance(k, Node):
                k.parent = copy
        block.kids = [copy]
        gone = self._at(self.formatting, found)
        del self.formatting[gone]
        self.formatting.insert(mark - (gone < mark), copy)
        del self.open[self._at(self.open, found)]
        self.open.insert(self._at(self.open, block) + 1, copy)

    # tokens

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        own: dict[str, str] = {}
        for k, v in attrs:
            own.setdefault(k, v or "")
        self._start(tag, own)

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in TABLE_PARTS:
            self._table_part(tag, attrs)
        elif tag in ("html", "head", "body", "frameset", "frame"):
            return
        elif tag == "table" and self.open[-1].tag in NO_CONTENT:  # ends the table that it stands in
            self._pop_through(("table",))
            self._start(tag, attrs)
        else:
            self._body_start(tag, attrs)

    def feed_regular(self, page: str) -> bool:
        """Take a regular page as a whole; False, with a useless tree, if it is none."""
        found = TOKEN.findall(page)
        if sum([len(t[0]) for t in found]) != len(page):
            return False
        open_, formatting = self.open, self.formatting
        for text, end, tag, attrs, closed in found:
            if not tag:
                if "&" in text:
                    text = unescape(text)
                top = open_[-1]
                if top.tag not in NO_CONTENT and (not formatting or formatting[-1] is None):
                    top.kids.append(text)
                else:
                    self.handle_data(text)
                continue
            tag = tag.lower()
            if end:
                if attrs or closed:
                    return False
                if tag in TABLE_PARTS and open_[-1].tag == tag:
                    self._pop()
                else:
                    self.handle_endtag(tag)
            elif tag in RAW_TEXT:
                return False
            elif closed:
                self.handle_startendtag(tag, [(k.lower(), v) for k, v in ATTRIBUTE.findall(attrs)])
            else:
                own: dict[str, str] = {}
                if attrs:
                    for k, v in ATTRIBUTE.findall(attrs):
                        own.setdefault(k.lower(), v)
                if not (tag in CELLS or tag == "tr") or not self._next_part(tag, own):
                    self._start(tag, own)
        return True

    def _next_part(self, tag: str, attrs: dict[str, str]) -> bool:
        """The plain cases of a cell or row: what it follows ends, and it is put in; False if there is more to do."""
        open_ = self.open
        if open_[-1].tag in CELLS:
            self._pop()
        if tag == "tr" and open_[-1].tag == "tr":
            open_.pop()
        top = open_[-1]
        if top.tag not in (BODIES if tag == "tr" else TR):
            return False
        n = Node(tag, attrs, top)
        top.kids.append(n)
        open_.append(n)
        if tag != "tr":
            self.formatting.append(None)
        return True

    def _table_part(self, tag: str, attrs: dict[str, str]) -> None:
        if not self._in_scope(("table",), TABLE_SCOPE):
            return
        # a cell or caption of this table ends
        for n in reversed(self.open):
            inner = n.tag
            if inner in TABLE_PARTS or inner == "table":
                break
        if inner in CELLS or inner == "caption":
            self._pop_through((inner,))
            self._table_part(tag, attrs)
            return
        if tag in CELLS:
            if inner != "tr":
                self._table_part("tr", {})
            self._pop_to(TR)
        elif tag == "tr":
            if inner not in BODIES and inner != "tr":
                self._table_part("tbody", {})
            self._pop_to(BODIES)
        elif tag == "col":
            if inner != "colgroup":
                self._table_part("colgroup", {})
            self._pop_to(frozenset(("colgroup",)))
        else:
            self._pop_to(TABLE)
        self._push(tag, attrs, tag != "col")

    def _body_start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ENDS_P:
            self._close_p()
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self._pop()
        elif tag == "li" or tag in ("dd", "dt"):
            same = ("li",) if tag == "li" else ("dd", "dt")
            for n in reversed(self.open):
                if n.tag in same:
                    self._implied(n.tag)
                    self._pop_through((n.tag,))
                    break
                if n.tag in SPECIAL and n.tag not in ("address", "div", "p"):
                    break
            self._close_p()
        elif tag in ("option", "optgroup"):
            if self.open[-1].tag == "option":
                self._pop()
            if tag == "optgroup" and self.open[-1].tag == "optgroup":
                self._pop()
        elif tag == "button" and self._in_scope(("button",)):
            self._implied()
            self._pop_through(("button",))
        elif tag in ("rp", "rt", "rb", "rtc") and self._in_scope(("ruby",)):
            self._implied("rtc" if tag in ("rp", "rt") else "")
        elif tag == "a" or tag == "nobr":
            end = next((i for i in range(len(self.formatting) - 1, -1, -1) if self.formatting[i] is None), -1)
            if before := next((n for n in self.formatting[end + 1 :] if n.tag == tag), None):
                self._end_formatting(tag)
                if self._at(self.formatting, before) >= 0:
                    self.formatting.remove(before)
                if (at := self._at(self.open, before)) >= 0:
                    del self.open[at]
        in_place = tag in ("script", "style", "template") or tag == "input" and attrs.get("type", "").lower() == "hidden"
        if in_place and self.open[-1].tag in NO_CONTENT:
            n = Node(tag, attrs, self.open[-1])
            self.open[-1].kids.append(n)
            if tag not in VOID:
                self.open.append(n)
                if tag in MARKERS:
                    self.formatting.append(None)
            return
        if tag not in ENDS_P and not in_place and tag not in ("li", "dd", "dt", "link", "meta", "base", "title"):
            self._reopen()
        n = self._push(tag, attrs, tag not in VOID)
        if tag in FORMATTING:
            self._remember(n)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        """Only elements of drawings and formulas end by a slash in their start tag."""
        self.handle_starttag(tag, attrs)
        if tag not in VOID and any(n.tag in ("svg", "math") for n in self.open) and self.open[-1].tag == tag:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "head", "body"):
            return
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag == "p":
            if not self._in_scope(("p",), BUTTON_SCOPE):
                self._push("p", {})
            self._implied("p")
            self._pop_through(("p",))
        elif tag == "table" or tag in TABLE_PARTS:
            if self._in_scope((tag,), TABLE_SCOPE):
                self._pop_through((tag,))
        elif tag in HEADINGS:
            if self._in_scope(HEADINGS):
                self._pop_through(HEADINGS)
        elif tag in FORMATTING:
            self._end_formatting(tag)
        elif tag in BLOCKS or tag in ("li", "dd", "dt", "form", "button", "applet", "marquee", "object"):
            if self._in_scope((tag,), LIST_SCOPE if tag == "li" else SCOPE):
                self._implied(tag)
                self._pop_through((tag,))
        else:
            self._end_other(tag)

    def _end_other(self, tag: str) -> None:
        for n in reversed(self.open[1:]):
            if n.tag == tag:
                self._implied(tag)
                while self._pop() is not n:
                    pass
                return
            if n.tag in SPECIAL:
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag in NO_CONTENT:
            if data.isspace():  # white space between a table's parts stays there
                self.open[-1].kids.append(data)
                return
            self._reopen()
        elif self.formatting and self.formatting[-1] is not None and not data.isspace():
            self._reopen()
        self._place(self.open[-1], data)


def parse(page: str | None) -> Node:
    b = TreeBuilder()
    if not b.feed_regular(page or ""):
        b = TreeBuilder()
        b.feed(page or "")
        b.close()
    return b.root


class Layouts:
    """What ``parts`` takes from pages' trees, by layout: pages of equal tags, but for texts and links, have equal trees.

    ``parts(root)`` gives ``(shape, strings)`` and must look at the tree's elements and at other attributes than
    ``href`` and ``title`` alone. A layout that is met again gets a tree with marks for what differs, kept while there is
    room; pages with entities or of an irregular layout are parsed each on its own.
    """

    #: Characters of layouts that are kept, and of the largest page that is looked up.
    ROOM, LONGEST = 4_000_000, 20_000
    #: Layouts met once that are remembered.
    MET = 50_000

    def __init__(self, parts: Callable[[Node], tuple]):
        self.parts = parts
        self.known: dict[str, tuple | None] = {}
        self.used = 0
        self.met: set[int] = set()

    def of(self, page: str | None) -> tuple:
        if not page or len(page) > self.LONGEST or "&" in page or MARK in page:
            return self.parts(parse(page))
        pieces = SLOT.split(page)
        key = MARK.join(pieces[::2])
        found = self.known.get(key, key)
        if found is key:
            found = self._learn(key, pieces) if (h := hash(key)) in self.met else None
            if len(self.met) >= self.MET:
                self.met.clear()
            self.met.add(h)
        if found is None:
            return self.parts(parse(page))
        shape, strings = found
        # a string is one piece of the page, or several with what stands between them
        return shape, [pieces[x] if x.__class__ is int else x if x is None or x.__class__ is str else "".join([pieces[k] if k.__class__ is int else k for k in x]) for x in strings]

    def _learn(self, key: str, pieces: list[str]) -> tuple | None:
        if self.used + len(key) > self.ROOM:
            self.known.clear()
            self.used = 0
        self.used += len(key)
        marked = "".join(f"{MARK}{i}{MARK}" if i % 2 else p for i, p in enumerate(pieces))
        b = TreeBuilder()
        found = None
        if not OTHER_VALUE.search(marked) and b.feed_regular(marked):
            shape, strings = self.parts(b.root)
            found = shape, [self._pieces(x) for x in strings]
        self.known[key] = found
        return found

    @staticmethod
    def _pieces(text: str | None) -> object:
        if text is None or MARK not in text:
            return text
        got = [int(p) if i % 2 else p for i, p in enumerate(text.split(MARK))]
        got = [p for p in got if p != ""]
        return got[0] if len(got) == 1 else tuple(got)
