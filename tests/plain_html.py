"""Text nodes of HTML by a parser, for comparison."""

from __future__ import annotations

from html.parser import HTMLParser


class _TextNodes(HTMLParser):
    """Collects the text nodes a browser would show, in document order."""

    # Elements whose own text is no page text, and those that keep white space.
    HIDDEN = ("script", "style", "template", "rt", "rp")
    VERBATIM = ("pre", "textarea")
    VOID = (
        "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
    )
    BLANKS = " \n\t\f\r"

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[str] = []
        self._pending: list[str] = []
        self._open: list[str] = []

    def _close_node(self) -> None:
        text = "".join(self._pending)
        self._pending = []
        if not text or (self._open and self._open[-1] in self.HIDDEN):
            return
        if not text.strip(self.BLANKS) and not any(tag in self.VERBATIM for tag in self._open):
            text = "\n" if "\n" in text else " "
        self.nodes.append(text)

    def handle_starttag(self, tag, attrs) -> None:
        self._close_node()
        if tag not in self.VOID:
            self._open.append(tag)

    def handle_startendtag(self, tag, attrs) -> None:
        self._close_node()

    def handle_endtag(self, tag) -> None:
        self._close_node()
        if tag in self._open:
            while self._open.pop() != tag:
                pass

    def handle_data(self, data) -> None:
        self._pending.append(data)

    def handle_comment(self, data) -> None:
        self._close_node()

    def handle_decl(self, decl) -> None:
        self._close_node()

    def handle_pi(self, data) -> None:
        self._close_node()

    def unknown_decl(self, data) -> None:
        self._close_node()
        if data.upper().startswith("CDATA["):
            self.nodes.append(data[len("CDATA["):])

    def text(self) -> str:
        self.close()
        self._close_node()
        return "\n".join(self.nodes).strip()


def text_lines(html: str | None) -> str:
    if not isinstance(html, str) or not html:
        return ""
    parser = _TextNodes()
    parser.feed(html)
    return parser.text()
