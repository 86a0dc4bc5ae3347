"""Per-page HTML walk (a small helper run inside ``mapInPandas``).

Real pages are not well-formed XML, so Spark's ``xpath`` cannot be used.  A
stdlib ``html.parser`` pass keeps a stack of open elements (closing an open
``p`` when a block element starts, as browsers do) and reports, per page:

* title candidates: first text of ``h1#firstHeading``, of
  ``h1.firstHeading``, first direct text of any ``h1``, first ``title`` text
* content text nodes, in document order, that lie in a ``p`` which is
  - a child of ``div.mw-parser-output`` inside ``div#mw-content-text``
    and not inside a table, or
  - inside ``div#bodyContent`` and not inside a table or ``div.navbox``, or
  - inside ``article`` and not inside ``nav`` or ``aside``
* ``href`` values of ``a`` and ``area`` elements, in document order, and of
  the first ``base`` element
* whether the parser gave up on the page

Everything else (filters, joins, lengths, links, traversal) is Spark SQL.
"""

from __future__ import annotations

from html.parser import HTMLParser

# HTML elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Start tags that close an open paragraph.
CLOSES_P = frozenset(
    "address article aside blockquote details dd div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split()
)


class _Walker(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, dict]] = []
        self.h1_id = None
        self.h1_class = None
        self.h1_any = None
        self.title = None
        self.nodes: list[str] = []
        self.links: list[str] = []
        self.base = None

    # -- tree maintenance
    def _close(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_starttag(self, tag, attrs):
        a = {k: (v or "") for k, v in attrs}
        if tag in ("a", "area") and "href" in a:
            self.links.append(a["href"])
        if tag == "base" and self.base is None and "href" in a:
            self.base = a["href"]
        if tag in CLOSES_P and any(t == "p" for t, _ in self.stack):
            self._close("p")
        if tag not in VOID:
            self.stack.append((tag, a))

    def handle_startendtag(self, tag, attrs):
        a = {k: (v or "") for k, v in attrs}
        if tag in ("a", "area") and "href" in a:
            self.links.append(a["href"])
        if tag == "base" and self.base is None and "href" in a:
            self.base = a["href"]

    def handle_endtag(self, tag):
        self._close(tag)

    # -- text
    def _in_content(self) -> bool:
        st = self.stack
        for i, (tag, _) in enumerate(st):
            if tag != "p":
                continue
            above = st[:i]
            names = [t for t, _ in above]
            if "table" not in names:
                parent = above[-1] if above else None
                if (parent and parent[0] == "div" and parent[1].get("class") == "mw-parser-output"
                        and any(t == "div" and at.get("id") == "mw-content-text" for t, at in above[:-1])):
                    return True
                if (any(t == "div" and at.get("id") == "bodyContent" for t, at in above)
                        and not any(t == "div" and at.get("class") == "navbox" for t, at in above)):
                    return True
            if "article" in names and "nav" not in names and "aside" not in names:
                return True
        return False

    def handle_data(self, data):
        st = self.stack
        if not st:
            return
        tags = [t for t, _ in st]
        if self.title is None and tags[-1] == "title":
            self.title = data
        for t, a in st:
            if t == "h1":
                if self.h1_id is None and a.get("id") == "firstHeading":
                    self.h1_id = data
                if self.h1_class is None and a.get("class") == "firstHeading":
                    self.h1_class = data
        if self.h1_any is None and tags[-1] == "h1":
            self.h1_any = data
        if self._in_content():
            self.nodes.append(data)


def walk_html(html: str | None) -> dict:
    w = _Walker()
    failed = False
    if html:
        try:
            w.feed(html)
            w.close()
        except (AssertionError, ValueError):  # malformed beyond repair: the page counts as failed
            failed = True
    return {
        "h1_id": w.h1_id, "h1_class": w.h1_class, "h1_any": w.h1_any, "title_tag": w.title,
        "nodes": w.nodes, "hrefs": w.links, "base_href": w.base, "failed": failed,
    }


WALK_SCHEMA = (
    "page_id long, url string, h1_id string, h1_class string, h1_any string, title_tag string, "
    "nodes array<string>, hrefs array<string>, base_href string, failed boolean"
)


#: Pages whose results a task holds at a time.
PAGES = 200


def walk_pages(batches):
    """mapInPandas body: (page_id, url, html) batches -> WALK_SCHEMA rows."""
    import pandas as pd

    for pdf in (whole[i:i + PAGES] for whole in batches for i in range(0, len(whole), PAGES)):
        out = [walk_html(h) for h in pdf["html"]]
        res = pd.DataFrame(out, columns=["h1_id", "h1_class", "h1_any", "title_tag", "nodes", "hrefs",
                                          "base_href", "failed"])
        res.insert(0, "url", pdf["url"].values)
        res.insert(0, "page_id", pdf["page_id"].values)
        yield res
