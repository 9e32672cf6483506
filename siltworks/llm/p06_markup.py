"""Problem 6: markup residue in text fields.

Method: a tree-structured graphical model. A field is parsed into a tree: the page, its blocks
(lines), elements from their opening to their closing tag, other constructs that may be markup, the
texts inside constructs and the text nodes of elements. Every node has a hidden state: for pages,
blocks and constructs *markup or not*, for texts *content or not*. Parent-child potentials connect
them, unary potentials come from what is seen of a node (its kind, what stands inside and beside
it). Sum-product message passing, upward and then downward, gives every node's marginal. A construct
whose markup marginal is at least ``CUT`` counts for its kind; a text is kept by its content marginal,
so that scripts, style sheets and navigation go.

The potentials are trained from labelled pages (``labelled_pages``): the project's tables have no
labels, so pages are rendered from a small page grammar in which each state is known, both real
markup and look-alikes (matrices, sets, derivatives, products, comparisons), both content and
boilerplate. Their number is a parameter, ``PAGES``; training takes a second on the driver.
``held_out`` measures the model on pages of another seed.

Formulas between dollars or ``\\[ \\]``, and environments for mathematics, are leaves that stay
as they are. ``clean`` keeps headings as ``# ``, items as ``- ``, code in fences, cells by `` | ``.

Defined results: null and blank fields hold no markup and are cleaned to themselves; texts are
taken whole; a record delivered twice counts once; extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks import runtime

PAGES = 3_000
CUT = 0.5
KINDS = ("html", "markdown", "wiki", "latex")

# Names of the markup languages.
_TAGS = "a abbr b blockquote body br center cite code dd del div dl dt em figure font footer h1 h2 h3 h4 h5 h6 head header hr html i img ins li link main mark math meta nav ol p pre q s script section small span strike strong style sub sup table tbody td tfoot th thead title tr tt u ul var video".split()
_MATH_ENV = r"(?:[pbvVB]?matrix|smallmatrix|align|aligned|equation|cases|array|gather|gathered|multline|eqnarray|split|displaymath)\*?"
_TEXT_ENV = r"(?:itemize|enumerate|description|center|quote|quotation|verse|verbatim|lstlisting|abstract|document|figure|table|tabular|flushleft|flushright|minipage|proof|theorem|lemma|example|problem|solution)\*?"
_SECTION = r"(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph|title)\*?"
_SWITCH = r"\{\\(?:bf|it|em|tt|sc|rm|large|Large|small)\b"
_STYLE = r"(?:textbf|textit|emph|underline|texttt|textsc|textrm|textsf|textsl|textnormal)"
_SPACE = r"(?:vspace|hspace)\*?"
_BARE = r"(?:noindent|bigskip|medskip|smallskip|newpage|clearpage|pagebreak|newline|linebreak|centering|maketitle|hfill|vfill|indent|hline|par)"
_NOTE = r"(?:footnote|marginpar|thanks|caption)"
_REFER = r"(?:label|ref|eqref|pageref|autoref|cite[pt]?|bibliography|includegraphics|usepackage|documentclass|url|href)"
_BRACES = r"\{(?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*\}"

#: name -> (kind, pattern). Earlier ones win where two begin at the same place.
_CONSTRUCTS: dict[str, tuple[str, str]] = {
    "formula": ("", rf"\$\$.+?\$\$|\$[^$\n]+\$|\\\[.+?\\\]|\\\(.+?\\\)|\\begin\{{(?P<menv>{_MATH_ENV})\}}.*?\\end\{{(?P=menv)\}}"),
    "fence": ("markdown", r"```[^\n]*\n.*?(?:```|\Z)"),
    "comment": ("html", r"<!--.*?-->"),
    "tag": ("html", r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>"),
    "entity": ("html", r"&(?:[A-Za-z]{2,8}|#\d{1,6}|#[xX][0-9A-Fa-f]{1,5});"),
    "wtable": ("wiki", r"^\{\|.*?^\|\}"),
    "wlink": ("wiki", r"\[\[[^\[\]\n]+\]\]"),
    "template": ("wiki", r"\{\{[^{}\n]+\}\}"),
    "wnested": ("wiki", r"\{\{(?:[^{}\n]|\{[^{}]*\})+\}\}|\{\{[^\n]*?\}\}|\[\[(?:[^\[\]\n]|\[[^\[\]\n]*\])*\]\]|\[\[[^\n]*?\]\]"),
    "wemph": ("wiki", r"'{2,5}(?=[^'\s])[^'\n]+(?:'[^'\n]+)*?'{2,5}"),
    "wheading": ("wiki", r"^={2,6}[ \t]*[^=\n][^\n]*?={2,6}[ \t]*$"),
    "image": ("markdown", r"!\[[^\]\n]*\]\([^()\n]*\)"),
    "link": ("markdown", r"\[[^\[\]\n]+\]\([^()\s]+(?:\s+\"[^\"\n]*\")?\)"),
    "mheading": ("markdown", r"^#{1,6}[ \t]+(?=\S)"),
    "mtable": ("markdown", r"^[ \t]*\|[^\n]+\|[ \t]*\n[ \t]*\|(?:[ \t]*:?-{2,}:?[ \t]*\|)+[ \t]*(?:\n[ \t]*\|[^\n]*\|[ \t]*$)*"),
    "quote": ("markdown", r"^[ \t]{0,3}>[ \t]?(?=\S)"),
    "item": ("markdown", r"^[ \t]{0,3}[-*+][ \t]+(?=[^\W\d_$¿¡(\[\"“«*`_\\])|^[ \t]{0,3}[-*+][ \t]+(?=\S[^\n]*\n[ \t]{0,3}[-*+][ \t])"),
    "bold": ("markdown", r"\*\*(?=\S)[^*\n]+?(?<=\S)\*\*|(?<!\w)__(?=\S)[^_\n]+?(?<=\S)__(?!\w)"),
    "strike": ("markdown", r"~~(?=\S)[^~\n]+?(?<=\S)~~"),
    "italic": ("markdown", r"(?<![\w*\\])\*(?=[^\s*])[^*\n]+?(?<=[^\s*])\*(?![\w*])|(?<![\w_\\])_(?=[^\s_])[^_\n]+?(?<=[^\s_])_(?![\w_])"),
    "code": ("markdown", r"`[^`\n]+`"),
    "rule": ("markdown", r"^[ \t]*(?:-{3,}|\*{3,}|_{3,})[ \t]*$"),
    "env": ("latex", rf"\\(?:begin|end)\{{{_TEXT_ENV}\}}(?:\[[^\]\n]*\])?"),
    "litem": ("latex", r"\\item\b(?:\[[^\]\n]*\])?[ \t]*"),
    "section": ("latex", rf"\\{_SECTION}{_BRACES}"),
    "style": ("latex", rf"\\{_STYLE}{_BRACES}|{_SWITCH}[^{{}}]*\}}"),
    "space": ("latex", rf"\\{_SPACE}\{{[^{{}}\n]*\}}|\\{_BARE}\b"),
    "note": ("latex", rf"\\{_NOTE}{_BRACES}"),
    "refer": ("latex", rf"~?\\{_REFER}(?:\[[^\]\n]*\])?\{{[^{{}}\n]*\}}"),
}
_SCAN = re.compile("|".join(f"(?P<{n}>{p})" for n, (_, p) in _CONSTRUCTS.items()), re.S | re.M)
#: What a field must hold for any construct to begin.
MAY = re.compile(rf"[<&`*_~]|\[\[|\{{\{{|\{{\||''|==|\]\(|^#|^[ \t]*[>|+\-]|\\(?:begin|end|item|{_SECTION}|{_STYLE}|{_SPACE}|{_BARE}|{_NOTE}|{_REFER})(?![a-zA-Z])|{_SWITCH}", re.M)
_WORD = re.compile(r"[^\W\d_]{2,}")
_DROPPED = {"comment", "image", "template", "refer"}  # and links to files and categories


def _inner(name: str, s: str) -> str:
    """numeric, symbols or words: what a construct is made of, its marks and any target left off."""
    if name == "tag":
        t = s.strip("</> ").split()[0].rstrip("/").lower() if s.strip("</> ") else ""
        return "known" if t in _TAG_SET else "unknown"
    if name == "entity":
        return "known" if html.unescape(s) != s else "unknown"
    if _WORD.search(s):
        return "words"
    return "numeric" if any(c.isdigit() for c in s) else "symbols"


_TAG_SET = frozenset(_TAGS)


def _beside(c: str) -> str:
    return "edge" if not c or c == "\n" else "space" if c.isspace() else "alnum" if c.isalnum() else "mark"


class Node:
    __slots__ = ("block", "end", "features", "name", "parent", "start", "text")

    def __init__(self, parent, name, start, end, features=(), text=""):
        self.parent, self.name, self.start, self.end, self.features, self.text = parent, name, start, end, features, text


_FORMULAS = re.compile(r"\$[^$]*\$|\\\[.*?\\\]|\\\(.*?\\\)|\\[A-Za-z]+(?:\{[^{}]*\})*", re.S)
_LINE_MARKS = ("quote", "item", "mheading", "litem")
_VOID = ("br", "img", "hr", "meta", "link", "input")


def _line_end(text: str, at: int) -> int:
    end = text.find("\n", at)
    return len(text) if end < 0 else end


def _tag_name(s: str) -> str:
    return s.strip("<>").split()[0].rstrip("/").lower()


def _text_node(parent: int, tag: str, text: str, start: int, end: int) -> Node:
    """The text of an element between its tags."""
    s = text[start:end]
    bare = _FORMULAS.sub(" ", s)
    marks = sum(bare.count(c) for c in "{};=")
    features = (("inner", _inner("text", s)), ("code", "yes" if 8 * marks >= len(bare.split()) + 1 and marks > 1 else "no"), ("size", "long" if len(s) > 60 else "short"))
    return Node(parent, "in:" + (tag if tag in _TAG_SET else "other"), start, end, features, s)


def parse(text: str) -> list[Node]:
    """The tree as a list; parents come before their children, the page is node 0."""
    nodes = [Node(-1, "page", 0, len(text))]
    found = [m for m in _SCAN.finditer(text) if m.lastgroup]
    block_of: dict[int, int] = {}
    open_tags: list[tuple[str, int]] = []
    at = 0  # how far the text of the innermost open element has been taken
    for m in found:
        name = next(n for n in _CONSTRUCTS if m.start(n) >= 0)
        if name == "formula":
            continue
        if open_tags and text[at : m.start()].strip():
            nodes.append(_text_node(open_tags[-1][1], open_tags[-1][0], text, at, m.start()))
        at = m.end()
        line = text.rfind("\n", 0, m.start()) + 1
        if line not in block_of:
            block_of[line] = len(nodes)
            nodes.append(Node(0, "block", line, line))
        s = m.group()
        before, after = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
        # what a mark at a line's start applies to is the rest of the line
        rest = text[m.end() : _line_end(text, m.end())] if name in _LINE_MARKS else s
        features = (("inner", _inner(name, rest)), ("left", _beside(before)), ("right", _beside(after)))
        parent = block_of[line]
        if name == "tag":
            t = _tag_name(s)
            if t.startswith("/"):
                for k in range(len(open_tags) - 1, -1, -1):
                    if open_tags[k][0] == t[1:]:
                        parent = open_tags[k][1]
                        del open_tags[k:]
                        break
            else:
                parent = open_tags[-1][1] if open_tags else parent
                if not s.endswith("/>") and t not in _VOID:
                    open_tags.append((t, len(nodes)))
        elif open_tags:
            parent = open_tags[-1][1]
        nodes.append(Node(parent, name, m.start(), m.end(), features, s))
        if name not in ("tag", "env", "rule", "space", "item", "litem", "quote", "mheading"):
            inner = "file" if name == "wlink" and re.match(r"\[\[\s*(?:file|image|category|datei|fichier|archivo)\s*:", s, re.I) else name
            nodes.append(Node(len(nodes) - 1, "text:" + inner, m.start(), m.end(), (("inner", _inner("text", s)),), s))
    if open_tags and text[at:].strip():
        # an element that isn't closed ends with the line of its last tag
        end = _line_end(text, at)
        if text[at:end].strip():
            nodes.append(_text_node(open_tags[-1][1], open_tags[-1][0], text, at, end))
    return nodes


class Model:
    """Potentials: ``edge[name][parent state] -> P(state 1)`` and ``unary[name, feature, value] -> (P(.|0), P(.|1))``."""

    def __init__(self, pages: list[tuple[list[Node], list[int]]]):
        edge: dict = defaultdict(lambda: [[1.0, 1.0], [1.0, 1.0]])
        unary: dict = defaultdict(lambda: [0.0, 0.0])
        total: dict = defaultdict(lambda: [0.0, 0.0])
        for nodes, states in pages:
            for node, s in zip(nodes, states, strict=True):
                edge[node.name][states[node.parent] if node.parent >= 0 else 0][s] += 1
                for f, v in node.features:
                    unary[node.name, f, v][s] += 1
                    total[node.name, f][s] += 1
        self.edge = {n: np.array([[a / (a + b), b / (a + b)] for a, b in rows]) for n, rows in edge.items()}
        self.unary = {k: np.array([(c[s] + 0.5) / (total[k[:2]][s] + 3.0) for s in (0, 1)]) for k, c in unary.items()}
        self.unseen = {k: np.array([0.5 / (t[s] + 3.0) for s in (0, 1)]) for k, t in total.items()}
        self.even = np.array([[0.5, 0.5], [0.5, 0.5]])
        self.flat = np.array([0.5, 0.5])

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(state 1) of every node, by one upward and one downward sum-product pass."""
        n = len(nodes)
        own, edges = [], []
        for x in nodes:
            u = np.ones(2)
            for f, v in x.features:
                u = u * self.unary.get((x.name, f, v), self.unseen.get((x.name, f), self.flat))
            own.append(u)
            edges.append(self.edge.get(x.name, self.even))
        up: list = [None] * n
        gathered = [u.copy() for u in own]
        for i in range(n - 1, 0, -1):
            m = edges[i] @ gathered[i]
            up[i] = m / m.sum()
            gathered[nodes[i].parent] *= up[i]
            gathered[nodes[i].parent] /= gathered[nodes[i].parent].sum()
        belief: list = [None] * n
        belief[0] = gathered[0] * edges[0][0]
        belief[0] /= belief[0].sum()
        for i in range(1, n):
            b = belief[nodes[i].parent] / np.maximum(up[i], 1e-300)
            b = gathered[i] * (b @ edges[i])
            belief[i] = b / b.sum()
        return [float(b[1]) for b in belief]


def labelled_pages(pages: int = PAGES, seed: int = 7) -> list[tuple[list[Node], list[int]]]:
    """Pages rendered from a grammar whose constructs' states are known, parsed to labelled trees."""
    r = random.Random(seed)
    w = lambda: "".join(r.choice(("ka", "lo", "mi", "tre", "sun", "vor", "pel", "and", "ist")) for _ in range(r.randint(1, 4)))
    d = lambda: str(r.randint(0, 99))
    v = lambda: r.choice("abcknpqtxyz")
    words = lambda n=4: " ".join(w() for _ in range(r.randint(1, n)))
    formula = lambda: r.choice((f"${v()}_{{{v()}+1}} = {d()}{v()} - {d()}$", f"$\\frac{{{d()}}}{{{d()}}}$", f"$\\sum_{{i=1}}^{{{d()}}} ({d()}i + {d()})$", f"{v()} = {d()}", f"{{{d()}, {d()}}}", f"{v()} = {d()}; {v()} = {d()}"))
    said = lambda: r.choice((words(8) + ".", f"{words(6)} {formula()} {words(3)}.", f"{words(3)} {formula()}", words(2), f"{words(12)} {d()} {words(8)}. {words(9)}."))
    real = [
        lambda: f"<p>{said()}</p>", lambda: f"<ul><li>{said()}</li>\n<li>{said()}</li></ul>", lambda: f"<div>{said()}</div>", lambda: f"<td>{said()}</td>", lambda: f"<span>{said()}</span>", lambda: f"<b>{said()}</b>",
        lambda: f"<p>{words()}</p>", lambda: f"{w()}<br>", lambda: f"<b>{w()}</b>", lambda: f'<span style="color:#{d()}f">{w()}</span>', lambda: f"<ul><li>{words()}</li>\n<li>{words()}</li></ul>", lambda: f"<table><tr><td>{words()}</td></tr></table>", lambda: f"<!-- {words()} -->", lambda: f'<img src="{w()}.png">', lambda: f"{w()} &amp; {w()}", lambda: f"&nbsp;{w()}", lambda: f"&ldquo;{w()}&rdquo;", lambda: r.choice(("&nbsp;", "&amp;", "&lt;", "&#39;", "&copy;", "&ndash;")), lambda: f"<b>{v()}</b>", lambda: f"<div class=\"{w()}\">{words()}</div>",
        lambda: f"\n## {words()}\n", lambda: f"\n- {words()}\n- {words()}\n", lambda: f"\n> {words()}\n> {words()}\n", lambda: f"\n> {words(8)} {d()}.\n", lambda: f"**{v()}**", lambda: f"~~{v()}~~", lambda: f"`{v()}`", lambda: f"\n* {words()}\n* {words()}\n", lambda: f"**{words(2)}**", lambda: f"*{w()}*", lambda: f"__{w()}__", lambda: f"~~{words(3)}~~", lambda: f"`{w()}`", lambda: f"![{w()}](img/{w()}.png)", lambda: f"[{words(2)}](https://{w()}.org/{w()})", lambda: f"\n```python\nprint({d()})\n```\n", lambda: f"\n| {w()} | {w()} |\n|---|---|\n| {w()} | {d()} |\n", lambda: "\n---\n",
        lambda: f"\n== {words(3)} ==\n", lambda: f"[[{words(2)}]]", lambda: f"[[{w()}|{w()}]]", lambda: f"[[File:{w()}.svg|thumb]]", lambda: f"[[Category:{w()}]]", lambda: f"''{w()}''", lambda: f"'''{words(3)}'''", lambda: f"'''{v()}'''", lambda: f"{{{{{w()}|level={d()}}}}}", lambda: f"{{{{{w()}}}}}", lambda: f"{{{{{w()}|{{{{{w()}}}}}|{d()}}}}}", lambda: f"[[{w()}|see [{w()}] {w()}]]", lambda: f"\n{{| class=\"{w()}\"\n|-\n| {d()} || {d()}\n|}}\n",
        lambda: f"\\section*{{{words(3)}}}", lambda: f"\\textbf{{{w()}}}", lambda: f"\\emph{{{words(2)}}}", lambda: f"\\begin{{itemize}}\n\\item {words()}\n\\item {words()}\n\\end{{itemize}}", lambda: f"\\begin{{center}}\n{words()}\n\\end{{center}}", lambda: f"\\vspace{{{d()}mm}}", lambda: f"\\noindent {words()}", lambda: f"\\footnote{{{words()}}}", lambda: f"\\cite{{{w()}{d()}}}", lambda: f"\\label{{q:{w()}}}",
    ]
    like = [
        lambda: f"[[{d()},{d()}],[{d()},{d()}]]", lambda: f"[[{d()},{d()}]]", lambda: f"[[{d()}, {v()}]]", lambda: f"{{{{{d()},{d()}}},{{{d()}}}}}", lambda: f"{{{{{d()}}}}}", lambda: f"{{{{{v()},{v()}}}}}", lambda: f"{v()}''({v()}) = {d()}, {v()}'({v()}) == {d()}", lambda: f"{v()}*{v()}*{v()} = {d()}", lambda: f"{d()}*{d()}*{d()}", lambda: f"{d()} * {v()} * {d()}", lambda: f"{v()} < {d()} and {v()} > {d()}", lambda: f"{d()}<{v()} and {v()}>{d()}", lambda: f"{v()}<{v()} or {v()}>{d()}", lambda: "R&D", lambda: f"{v()}&{v()};", lambda: f"lot #{d()}", lambda: f"{v()}_{d()} = {v()}_{d()}", lambda: f"_{d()}_", lambda: f"*{d()}*", lambda: f"~~{d()}", lambda: f"\n- {d()}\n", lambda: f"\n-{d()}{v()}*{d()}\n", lambda: f"({d()}, {d()})", lambda: f"{{{d()},{d()}}}", lambda: f"\n> {d()}\n", lambda: f"{v()} == {d()}", lambda: f"''{v()}''({v()})", lambda: f"|{v()} - {d()}|",
    ]
    code = lambda: "".join(f"var {v()} = {d()}; " if r.random() < 0.5 else f"{w()}({v()}) {{ return {d()}; }} " for _ in range(r.randint(1, 4)))
    links = lambda: " ".join(f'<a href="/{w()}">{words(2)}</a>' for _ in range(r.randint(2, 5)))
    boilerplate = [lambda: f"<script>{code()}</script>", lambda: f'<script type="text/javascript">\n{code()}\n</script>', lambda: f"<style>.{w()} {{ color: #{d()}a; margin: {d()}px; }}</style>", lambda: f"<nav>{links()}</nav>", lambda: f"<footer>{words(5)} {links()}</footer>", lambda: f"<head><title>{words(3)}</title></head>"]
    out = []
    for _ in range(pages):
        text, spans, junk = "", [], []
        marked = r.random() < 0.6
        for _ in range(r.randint(1, 5)):
            text += words(6) + r.choice((". ", "? ", " ", " ", "", ".", "?", f" {d()}.", "$x$ ", "$x$", ".\n"))
            if r.random() < 0.6:
                is_real = marked and r.random() < 0.75
                is_junk = is_real and r.random() < 0.12
                s = r.choice(boilerplate if is_junk else real if is_real else like)()
                spans.append((len(text), len(text) + len(s), int(is_real)))
                if is_junk:
                    junk.append((len(text), len(text) + len(s)))
                text += s + r.choice(["", " ", "\n", ". ", ".", ", "])
        nodes = parse(text)
        states = [int(any(x for _, _, x in spans))]
        for x in nodes[1:]:
            if x.name == "block":
                end = text.find("\n", x.start)
                end = len(text) if end < 0 else end
                states.append(int(any(t and a <= end and b > x.start for a, b, t in spans)))
            elif x.name.startswith("text:"):
                states.append(int(not states[x.parent] or not (x.name[5:] in _DROPPED or x.name == "text:file")))
            elif x.name.startswith("in:"):
                states.append(int(not any(a <= x.start < b for a, b in junk)))
            else:
                states.append(int(any(t and a <= x.start < b for a, b, t in spans)))
        out.append((nodes, states))
    return out


@lru_cache(maxsize=1)
def model(pages: int = PAGES) -> Model:
    return Model(labelled_pages(pages))


def is_text(x: Node) -> bool:
    return x.name.startswith(("text:", "in:"))


def held_out(m: Model, pages: int = 1_000, seed: int = 8) -> dict[str, tuple[float, float]]:
    """(precision, recall) of markup among constructs and of content among text nodes, on pages of another seed."""
    n: dict[str, list[int]] = {"markup": [0, 0, 0], "content": [0, 0, 0]}  # both, found, true
    for nodes, states in labelled_pages(pages, seed):
        for x, s, p in zip(nodes, states, m.marginals(nodes), strict=True):
            if x.name not in ("page", "block"):
                c = n["content" if is_text(x) else "markup"]
                c[0] += s and p >= CUT
                c[1] += p >= CUT
                c[2] += s
    return {k: (both / max(found, 1), both / max(true, 1)) for k, (both, found, true) in n.items()}


def judged(text: str, m: Model) -> list[tuple[Node, bool]]:
    """The constructs and inner texts of a field: (node, state)."""
    if not text or not MAY.search(text):
        return []
    nodes = parse(text)
    if len(nodes) == 1:
        return []
    return [(x, p >= CUT) for x, p in zip(nodes, m.marginals(nodes), strict=True) if x.name not in ("page", "block")]


def kinds(text: str | None, m: Model) -> set[str]:
    return {_CONSTRUCTS[x.name][0] for x, is_markup in judged(text or "", m) if is_markup and not is_text(x)}


def _heading(level: int, s: str) -> str:
    return f"\n{'#' * level} {s.strip()}\n"


def _cells(rows: list[list[str]]) -> str:
    return "\n" + "\n".join(" | ".join(c.strip() for c in r if c.strip()) for r in rows if any(c.strip() for c in r)) + "\n"


def _render(x: Node, keep: bool, m: Model) -> str:
    s, name = x.text, x.name
    braced = lambda: clean(s[s.index("{") + 1 : -1], m)
    if not keep:
        return ""
    if name == "tag":
        t = s.strip("<>").split()[0].rstrip("/").lower()
        if re.fullmatch(r"h[1-6]", t):
            return "\n" + "#" * int(t[1]) + " "
        if t == "li":
            return "\n- "
        if t in ("pre", "/pre"):
            return "\n```\n"
        if t in ("td", "th"):
            return " | "
        return "\n" if t.lstrip("/") in ("p", "br", "div", "tr", "table", "ul", "ol", "hr", "blockquote", "section", "h1", "h2", "h3", "h4", "h5", "h6") else ""
    if name == "entity":
        return html.unescape(s)
    if name == "wtable":
        body = [line for line in s.split("\n")[1:-1] if line[:1] in "|!" and line[:2] not in ("|-", "|+")]
        return _cells([re.split(r"\|\||!!", line[1:]) for line in body])
    if name in ("wlink", "wnested") and s[0] == "[":
        return s[2:-2].split("|")[-1]
    if name == "wemph":
        return s.strip("'")
    if name == "wheading":
        n = len(s) - len(s.lstrip("="))
        return _heading(n, s.strip().strip("="))
    if name == "link":
        return s[1 : s.index("](")]
    if name == "mtable":
        return _cells([line.strip().strip("|").split("|") for i, line in enumerate(s.split("\n")) if i != 1])
    if name in ("bold", "strike", "italic", "code"):
        return s.strip({"bold": "*_", "strike": "~", "italic": "*_", "code": "`"}[name]) if name != "code" else s
    if name == "mheading":
        return s
    if name == "item" or name == "litem":
        return "\n- " if name == "litem" else "- "
    if name == "quote":
        return ""
    if name in ("rule", "env", "space"):
        return "\n" if name == "rule" or "\\begin" in s or "\\end" in s else " "
    if name == "section":
        return _heading(1 + s.count("sub"), braced())
    if name == "style":
        return braced() if s[0] == "\\" else re.sub(r"^\{\\\w+\s*|\}$", "", s)
    if name == "note":
        return f" ({braced()})"
    return s if name == "fence" else ""


def clean(text: str | None, m: Model) -> str | None:
    """Clean text with headings, lists, code, tables' cells and formulas kept; None stays None."""
    if text is None:
        return None
    found = judged(text, m)
    if not found:
        return text
    content = {x.start: s for x, s in found if x.name.startswith("text:")}
    out, at, begun = [], 0, False
    for x, state in found:
        if x.name.startswith("in:"):  # boilerplate inside an element goes, its content stays as it is
            if not state and x.start >= at:
                out.append(text[at : x.start])
                at, begun = x.end, True
            continue
        if is_text(x) or not state or x.start < at:
            continue
        out += [text[at : x.start], _render(x, content.get(x.start, True), m)]
        at, begun = x.end, True
    if not begun:
        return text
    out.append(text[at:])
    lines = [re.sub(r"[ \t]+", " ", line).strip() for line in "".join(out).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def _report(m: Model, fields: list[str]):
    def run(batches):
        for b in batches:
            rid, field, kind = [], [], []
            ids = b.column(0).to_pylist()
            for k, f in enumerate(fields):
                for i, t in zip(ids, b.column(k + 1).to_pylist(), strict=True):
                    if i is None or not t:
                        continue
                    for x in sorted(kinds(t, m)):
                        rid.append(i)
                        field.append(f)
                        kind.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (rid, field, kind)], ["record_id", "field", "kind"])

    return run


def _cleaner(m: Model, fields: list[str]):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([clean(t, m) for t in b.column(k + 1).to_pylist()], pa.string()) for k in range(len(fields)))], ["record_id", *fields])

    return run


FIELDS = ["question", "raw_dataset_answer"]


def found(records: DataFrame) -> DataFrame:
    """``(record_id, field, kind)`` of fields that hold markup of the kind."""
    return runtime.fit_partitions(records.select("record_id", *FIELDS)).mapInArrow(_report(model(), FIELDS), "record_id string, field string, kind string").distinct()


def cleaned(records: DataFrame) -> DataFrame:
    """``(record_id, question, raw_dataset_answer)`` as clean text, one row a delivered row."""
    return runtime.fit_partitions(records.select("record_id", *FIELDS)).mapInArrow(_cleaner(model(), FIELDS), "record_id string, question string, raw_dataset_answer string")


QUERIES = {
    "p6_found": lambda spark, d: found(runtime.table(spark, d, "canonical_records")),
    "p6_clean": lambda spark, d: cleaned(runtime.table(spark, d, "canonical_records")),
    "p6_report": lambda spark, d: found(runtime.table(spark, d, "canonical_records")).groupBy("field", "kind").agg(F.count("*").alias("records")),
}

# ---- the same by plain rules, to check the model's rows ----

_PLAIN = {
    "html": [("is", r"<!--.*?-->"), ("i", rf"</?(?:{'|'.join(_TAGS)})(?:\s[^<>]*)?/?>"), ("", r"&(?:amp|lt|gt|nbsp|quot|apos|ldquo|rdquo|lsquo|rsquo|ndash|mdash|hellip|copy|times|middot|eacute|uuml|#\d{1,6}|#[xX][0-9A-Fa-f]{1,5});")],
    "markdown": [
        ("m", r"^#{1,6}[ \t]+\S"), ("m", r"^[ \t]{0,3}[-*+][ \t]+(?:[^\W\d_¿¡«“]|[¿¡«“$*`\[(\\_][^\n]*[^\W\d_]{2})"), ("m", r"^[ \t]{0,3}>[ \t]?\S[^\n]*[^\W\d_]{2}"), ("", r"\*\*[^\s*](?:[^*\n]*[^\s*])?\*\*|~~[^\s~](?:[^~\n]*[^\s~])?~~"), ("", r"(?:^|[^\w_\\])__[^\s_](?:[^_\n]*[^\s_])?__(?:$|[^\w_])"),
        ("", r"(?:^|[^\w*\\])\*[^\W\d_](?:[^*\n]*[^\s*\d])?\*(?:$|[^\w*])"), ("", r"(?:^|[^\w_\\])_[^\W\d_](?:[^_\n]*[^\s_\d])?_(?:$|[^\w_])"), ("s", r"```[^\n]*\n"), ("", r"`[^`\n]+`"), ("", r"!\[[^\]\n]*\]\([^()\n]*\)"), ("", r"\[[^\[\]\n]*[^\W\d_]{2}[^\[\]\n]*\]\([^()\s]+(?:\s+\"[^\"\n]*\")?\)"), ("m", r"^[ \t]*\|(?:[ \t]*:?-{2,}:?[ \t]*\|)+[ \t]*$"), ("m", r"^[ \t]*(?:-{3,}|\*{3,}|_{3,})[ \t]*$"),
    ],
    "wiki": [("", r"\[\[[^\[\]\n]*[^\W\d_]{2}[^\n]*?\]\]"), ("", r"\{\{[^\n{}]*[^\W\d_]{2}[^\n]*?\}\}"), ("", r"(?:^|[^\w'])'{2,5}[^'\s][^'\n]*'{2,5}(?:$|[^\w'(])"), ("m", r"^={2,6}[ \t]*[^=\n]*[^\W\d_]{2}[^=\n]*={2,6}[ \t]*$"), ("m", r"^\{\|")],
    "latex": [("", _CONSTRUCTS[n][1]) for n in ("env", "litem", "section", "style", "space", "note", "refer")],
}


def _plain_sql() -> str:
    from siltworks.plans import sqltext as q

    formulas = q.sql(r"\$\$.+?\$\$|\$[^$\n]+\$|\\\[.+?\\\]|\\\(.+?\\\)" + "".join(rf"|\\begin\{{{e}\*?\}}.*?\\end\{{{e}\*?\}}" for e in _MATH_ENV[3:-4].replace("[pbvVB]?matrix", "pmatrix|bmatrix|matrix").split("|")), "s")
    rows = " UNION ALL ".join(f"SELECT record_id, '{f}' AS field, regexp_replace({f}, {formulas}, 'F', 'g') AS t FROM canonical_records WHERE record_id IS NOT NULL AND {f} IS NOT NULL" for f in FIELDS)
    return f"WITH t AS MATERIALIZED ({rows}) " + " UNION ".join(f"SELECT record_id, field, '{k}' AS kind FROM t WHERE {' OR '.join(q.has('t', p, f) for f, p in ps)}" for k, ps in _PLAIN.items())


ORACLES: dict[str, str] = {"p6_found": _plain_sql()}
ORACLES["p6_report"] = f"SELECT field, kind, count(*) AS records FROM ({ORACLES['p6_found']}) GROUP BY 1, 2"
