"""Small parsers from one text to (field, value) pairs, used inside Arrow UDFs."""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

Pairs = list[tuple[str, str]]
Parser = Callable[[str], Pairs]

# Elements whose text is not content, and elements that break a line.
SILENT = frozenset(("script", "style", "template", "noscript"))
BREAKING = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split()
)


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pairs: Pairs = []
        self.title: list[str] = []
        self.body: list[str] = []
        self.silent = 0
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
        elif tag == "title":
            self.in_title = True
        elif tag == "meta":
            found = dict(attrs)
            name = found.get("name") or found.get("property") or found.get("http-equiv")
            if name and found.get("content") is not None:
                self.pairs.append((name, found["content"]))
        if tag in BREAKING:
            self.body.append("\n")

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "title":
            self.in_title = False
        if tag in BREAKING:
            self.body.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.silent:
            self.body.append(data)


def parse_html(text: str) -> Pairs:
    page = _Page()
    page.feed(text)
    page.close()
    lines = (" ".join(line.split()) for line in "".join(page.body).splitlines())
    out = [("title", "".join(page.title).strip())] if page.title else []
    return out + page.pairs + [("content", "\n".join(line for line in lines if line))]


def parse_plain(text: str) -> Pairs:
    return [("content", text)]


def parse_unknown(text: str) -> Pairs:
    """Content of a type no parser knows: only its metadata is indexed."""
    return []


# Declared type -> parser; specs add their own.
PARSERS: dict[str, Parser] = {
    "text/html": parse_html,
    "application/xhtml+xml": parse_html,
    "text/plain": parse_plain,
}
