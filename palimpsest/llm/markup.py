"""Markup residue in article texts: detection, and clean text that keeps headings, lists, tables, code and formulas.

A text in HTML, Markdown, wiki or LaTeX markup, whole, broken or escaped, becomes a sequence of *nodes*: a piece of text with its
root-to-leaf tag path (``body/ul/li``, ``wiki/list``, ``latex/section``).  Per tag path the text length and the punctuation are
aggregated; the two ratios (per node of the path) are smoothed over the sequence of nodes, fused by their product and thresholded, so
paths of menus and other boilerplate fall out wherever they are, while headings, lists, tables, code and formulas stay by their kind.  A text
holds markup if the text of its content nodes differs from it in more than white space; ordinary uses of the same characters are set
aside before it is parsed.

Clean text is plain: ``§`` before a heading (one per level), ``•`` before a list item (two blanks per level), tabs between table
cells, four blanks before a line of code, and ``⟦ ⟧`` around a formula.
"""

from __future__ import annotations

import html
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.common import spread

# Names of HTML elements (with those of wiki extensions) and what they stand for.
BLOCK = "p div section article main header footer nav aside blockquote center figure figcaption address form fieldset dl dt dd body html hr".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
LISTS = "ul ol li menu".split()
TABLES = "table thead tbody tfoot tr td th caption colgroup col".split()
INLINE = (
    "a abbr acronym b bdi bdo big br cite code del dfn em font i img input ins kbd label mark math nowiki ref references s samp small "
    "span strike strong sub sup time tt u var wbr poem gallery syntaxhighlight source pre noinclude includeonly onlyinclude templatestyles"
).split()
DROPPED = "script style head title meta link noscript iframe object embed svg button select option textarea template".split()
ELEMENTS = frozenset([*BLOCK, *HEADINGS, *LISTS, *TABLES, *INLINE, *DROPPED])
EMPTY = frozenset("hr img input meta link col embed".split())
BOILERPLATE = frozenset("nav footer aside header form".split())

_NAMES = "|".join(sorted(ELEMENTS, key=len, reverse=True))
#: Ordinary uses of markup characters, blanked before detection.
_ORDINARY = re.compile(
    r"\[\[\s*-?[\d.]+(?:\s*,\s*-?[\d.]+)*\s*\](?:\s*,\s*\[[^\[\]<>&*'|]*\])+\s*\]"  # nested number lists
    r"|\[\[(?!\d{1,3}(?:,\d{3})+\]\])\s*-?[\d.]+(?:\s*,\s*-?[\d.]+)+\s*\]\s*\]"  # of one list, which only a comma tells from a link
    r"|\{\{\s*[\w.]*(?:\s*,\s*[\w.]+)*\s*\}(?:\s*,\s*\{[^{}]*\})+\s*\}"  # nested sets
    r"|\{\{\s*[\w.]*(?:\s*,\s*[\w.]+)+\s*\}\s*\}"  # of one set, which only a comma tells from a template
    r"|\{(?:\s*[\w.]+\s*(?:,\s*[\w.]+\s*)*)?(?:,\s*\{[^{}]*\}\s*)+\}"
    r"|(?<=\b\w)''+(?=\s*\()"  # second derivatives
    r"|(?<=\d)''(?!')"  # inches, seconds of arc
    r"|\b[A-Za-z]:(?:\\[\w.$ -]+)+"  # drive paths
    r"|(?<![\\\w])\\\\[\w.$-]+(?:\\[\w.$-]+)+"  # shares
    r"|\([^()\n|]*\|\|[^()\n|]*\)"  # a condition of a program
    r"|\[\d{1,3}\](?:\[\d{1,3}\])+(?!\()"  # numbers of references
    r"|(?<!\w)__(?:init|main|name|file|str|repr|len|new|call|del|dict|all|doc|eq|hash|iter|next|enter|exit)__(?!\w)"
)
#: Markup tokens, by kind.
_TOKENS = {
    "html": re.compile(
        rf"</?(?:{_NAMES})(?=[\s/>]|$)(?<![\w<]<)[^<>]*>?|<!--|-->|<!\[CDATA\[|<!DOCTYPE|<\?xml"
        rf"|&lt;/?\s*(?:{_NAMES})\b|&lt;!--|&(?:[A-Za-z][A-Za-z0-9]{{1,30}}|#\d{{1,7}}|#[xX][0-9A-Fa-f]{{1,6}});",
        re.I,
    ),
    "wiki": re.compile(
        r"\[\[|\]\]|\{\{|\}\}|(?<!')'{2,5}(?!')|\{\||^\|\}|^\|-|^\|\+|^!\s|\|\||__[A-Z]{3,}__|^={1,6}[^=\n].*?={1,6}\s*$|(?<!=)==(?=[^\s=])[^=\n]+(?<=[^\s=])==(?!=)"
        r"|^={2,6}\s*\w[^=\n]*$|^#(?:REDIRECT|redirect)\b|\[(?:https?|ftp)://|\|(?:thumb|left|right|center|frame|frameless|\d+px)\b|^:+\s*\S|^;\s*\S|^[*#]+[*#:;]+\s*\S|^\#\s\S|~{4,5}",
        re.M,
    ),
    "markdown": re.compile(
        r"^\s{0,3}\#{1,6}\s+\S|^\s{0,3}[-+*]\s+\S|^\s{0,3}>\s|^\s{0,3}(?:`{3,}|~{3,})|^(?:-{3,}|={3,}|\*{3,}|_{3,})\s*$|!\[|\]\(|\]\[|^\[[^\]\n]+\]:\s|\[\^[^\]\n]+\]"
        r"|`[^`\n]+`|``|\*\*(?=\S)|(?<=\S)\*\*|(?<![\w*])\*(?=[^\s*])[^*\n]+?(?<=[^\s*])\*(?![\w*])|~~|(?<!\w)__(?=[^\s_])[^\n]+?(?<=[^\s_])__(?!\w)"
        r"|(?<![\w_])_(?=[^\s_])[^_\n]+(?<=[^\s_])_(?![\w_])|^\s*\|.*\|\s*$|\\[*_`\#\[\]!>~]",
        re.M,
    ),
    "latex": re.compile(
        r"\\[A-Za-z]{2,}\*?|\\[a-zA-Z](?=\{)|\\[\[\](),;:!%&$\#{}]|\\\\|\$\$|(?<![\\$\w])\$(?=[^\s$\d])[^$\n]+(?<=[^\s$])\$(?![\w$])|(?<![\\$\w])\$(?=\d)[^$\n ]*[\\^_{}=][^$\n]*(?<=[^\s$])\$(?![\w$])"
        r"|(?<=\w)~(?=\s|\w|$)|``[^`'\n]+''|^%\s",
        re.M,
    ),
}
_PUNCTUATION = re.compile(r"[.,;:!?。、！？；：]")


def markup_kinds(text: str) -> set[str]:
    """Kinds of markup of which a text holds at least one token."""
    plain = _ORDINARY.sub(lambda m: " " * len(m.group()), text)
    return {kind for kind, token in _TOKENS.items() if token.search(plain)}


@dataclass
class Node:
    """A piece of text: its tag path, its kind, its level in a list or heading, and the text."""

    path: str
    kind: str  # text heading item row code formula
    level: int
    text: str


_FORMULA, _CODE = "\ue000", "\ue001"
_KEPT = re.compile("[\ue000\ue001](\\d+)\ue002")
_SET_ASIDE = (
    (_CODE, re.compile(r"<(?:pre|syntaxhighlight|source)\b[^<>]*>(.*?)</(?:pre|syntaxhighlight|source)\s*>", re.S | re.I)),
    (_CODE, re.compile(r"^\s{0,3}```[^\n`]*\n(.*?)^\s{0,3}```\s*$", re.S | re.M)),
    (_CODE, re.compile(r"\\begin\{(?:verbatim|lstlisting|minted)\}(?:\[[^\]]*\]|\{[^}]*\})?(.*?)\\end\{(?:verbatim|lstlisting|minted)\}", re.S)),
    (_FORMULA, re.compile(r"<math\b[^<>]*>(.*?)</math\s*>", re.S | re.I)),
    (_FORMULA, re.compile(r"\\begin\{((?:equation|align|gather|multline|eqnarray|displaymath|math)\*?)\}(.*?)\\end\{\1\}", re.S)),
    (_FORMULA, re.compile(r"\$\$(.+?)\$\$|\\\[(.+?)\\\]|\\\((.+?)\\\)", re.S)),
    (_FORMULA, re.compile(r"(?<![\\$\w])\$(?=[^\s$])([^$\n]*[\\^_=][^$\n]*)(?<=[^\s$])\$(?![\w$])")),
)
_ESCAPED = re.compile(rf"&lt;/?\s*(?:{_NAMES})\b(?:(?!&lt;|&gt;|\n).)*&gt;", re.I)
#: Where an unclosed element or comment without text of its own ends: a blank line or the tag of a block.
_BREAK = rf"\n\s*\n|</?(?:{'|'.join((*BLOCK, *HEADINGS, *LISTS, *TABLES))})(?=[\s/>])"
_COMMENT = re.compile(rf"<!--(?:(?:(?!<!--).)*?-->|.*?(?=<!--|{_BREAK}|\Z))", re.S | re.I)
_TAG = re.compile(rf"<(/?)({_NAMES})(?=[\s/>])([^<>]*?)(/?)>", re.I)


_S, _I, _M, _SI = int(re.S), int(re.I), int(re.M), int(re.S | re.I)
#: Forms are compiled once per process: looking them up in the library's own cache costs more than most searches.
_form = lru_cache(maxsize=None)(re.compile)


def _sub(form, new, text, flags=0):
    return _form(form, flags).sub(new, text) if isinstance(form, str) else form.sub(new, text)


def _subn(form, new, text, flags=0):
    return _form(form, flags).subn(new, text) if isinstance(form, str) else form.subn(new, text)


def _match(form, text):
    return _form(form).match(text)


def _search(form, text):
    return _form(form).search(text)


def _fullmatch(form, text):
    return _form(form).fullmatch(text)


def _split(form, text, maxsplit=0):
    return _form(form).split(text, maxsplit)


_CATEGORY = re.compile(r"\[\[(?:Category|Kategorie|Catégorie|Categoría|Категория|カテゴリ)\s*:[^\[\]]*\]\]", re.I)
_PICTURE = re.compile(r"\[\[(?:File|Image|Datei|Bild|Fichier|Archivo|Imagen|Файл|ファイル)\s*:(?:[^\[\]|]*\|)*([^\[\]|]*)\]\]", re.I)
#: Last parts of a picture that are no caption: its name or an option.
_OPTION = re.compile(r"(?:thumb(?:nail)?|left|right|center|none|frame(?:less|d)?|border|upright(?:=[\d.]+)?|\d*x?\d+px|(?:alt|link|class|lang)=.*|[^|]*\.(?:jpe?g|png|gif|svg|tiff?|webp|pdf|og[gvm]))?", re.I)


def _inline(text: str) -> str:
    """Text of inline markup, without its marks."""
    s = _COMMENT.sub("", text)
    s = _sub(r"<ref\b[^<>]*/>|<ref\b[^<>]*>.*?</ref\s*>|</?ref\b[^<>]*>?", "", s, flags=_SI)
    s = _sub(r"\\(?:begin|end)\{[^{}]*\}", "", s)
    s = _sub(r"\{\{\s*(?:convert|cvt)\s*\|([^{}|]*)\|([^{}|]*)[^{}]*\}\}", r"\1 \2", s)
    while True:  # nested templates from the inside out
        s, n = _subn(r"\{\{\s*(?:lang|nowrap|abbr)\s*\|(?:[^{}|]*\|)?([^{}|]*)\}\}", r"\1", s)
        s, m = _subn(r"\{\{[^{}]*\}\}", "", s)
        if not n + m:
            break
    while True:  # links from the inside out; of a picture its caption stays
        s, n = _subn(_CATEGORY, "", s)
        s, m = _subn(_PICTURE, lambda g: " " if _OPTION.fullmatch(g[1].strip()) else f" {g[1].strip()} ", s)
        s, k = _subn(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", s)
        if not n + m + k:
            break
    s = _sub(r"\[(?:https?|ftp)://\S+\s+([^\]]*)\]", r"\1", s)
    s = _sub(r"!?\[([^\]\n]*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)", r"\1", s)
    s = _sub(r"\[\^[^\]\n]*\]|^\[[^\]\n]+\]:\s.*$", "", s, flags=_M)
    s = _sub(r"\\href\{[^{}]*\}\{([^{}]*)\}", r"\1", s)
    s = _sub(r"\\(?:footnote|cite[tp]?|label|ref|eqref|index|includegraphics|usepackage|documentclass)\*?(?:\[[^\]]*\])?\{[^{}]*\}", "", s)
    while True:
        s, n = _subn(r"\\[A-Za-z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}", r"\1", s)
        if not n:
            break
    s = _sub(r"\\([%&$\#_{}*`\[\]!>~])", r"\1", s)
    s = _sub(r"(?<![\w:\\])\\[A-Za-z]{2,}\*?\{?(?![\\\w])", "", s)
    s = _sub(r"(?<!')'{2,5}(?!')|__[A-Z]{3,}__|\*\*(?=\S)|(?<=\S)\*\*|~~+|`+|\[\[|\]\]|\{\{|\}\}|\|(?:thumb|left|right|center|frame|frameless|\d+px)(?:\||\b)", "", s)
    s = _sub(r"(?<!=)==(?=[^\s=])([^=\n]+)(?<=[^\s=])==(?!=)", r"\1", s)
    s = _sub(r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![\w*])", r"\1", s)
    s = _sub(r"(?<![\w_])(_{1,2})(?=[^\s_])([^\n]+?)(?<=[^\s_])\1(?![\w_])", r"\2", s)
    s = _sub(r"(?<=\w)~(?=\s|\w|$)", " ", s)
    return html.unescape(s)


_CLASS = re.compile(r"\b(?:class|id)\s*=\s*[\"']?\s*([\w-]+)", re.I)


def _unclosed(text: str) -> set[int]:
    """Places of the opening tags of dropped elements that no closing tag follows."""
    opened = defaultdict(list)
    for m in _TAG.finditer(text):
        name = m[2].lower()
        if name not in DROPPED or name in EMPTY or m[4]:
            continue
        if not m[1]:
            opened[name].append(m.start())
        elif opened[name]:
            opened[name].pop()
    return {at for places in opened.values() for at in places}


def _html_nodes(text: str, wiki: bool = False) -> Iterator[Node]:
    """Nodes of a text with HTML elements; unknown angle brackets are text, unclosed and stray tags are tolerated."""
    stack: list[str] = []
    classes: list[str] = []  # of the same elements, as they stand in a path
    buffer: list[str] = []
    cells: list[str] = []

    def flush() -> Iterator[Node]:
        piece = "".join(buffer)
        buffer.clear()
        if any(t in DROPPED for t in stack) or not piece.strip():
            return
        path = "/".join(["html", *[t + c for t, c in zip(stack, classes) if t not in INLINE]])
        heads = [t for t in stack if t in HEADINGS]
        if any(t in ("td", "th") for t in stack):
            cells.append(" ".join(piece.split()))
        elif heads:
            yield Node(path, "heading", int(heads[-1][1]), piece)
        elif "li" in stack:
            yield Node(path, "item", max(1, sum(t in ("ul", "ol", "menu") for t in stack)), piece)
        else:
            yield from _line_nodes(piece, path, wiki)

    unclosed, skipping = _unclosed(text), False

    def take(piece: str) -> None:
        nonlocal skipping
        if skipping:  # after an unclosed dropped element, up to a blank line
            rest = _split(r"\n\s*\n", piece, maxsplit=1)
            skipping, piece = len(rest) == 1, "\n\n".join(["", *rest[1:]])
        buffer.append(piece)

    last = 0
    for m in _TAG.finditer(text):
        take(text[last : m.start()])
        last = m.end()
        closing, name, attributes, empty = m.groups()
        name = name.lower()
        skipping = m.start() in unclosed or (skipping and (name == "br" or name in INLINE or name in DROPPED))
        if name == "br":
            buffer.append("\n" if not closing else "")
            continue
        if name in INLINE:
            continue
        yield from flush()
        if name == "tr" or name == "table":
            if cells:
                yield Node("/".join(["html", *stack]), "row", 1, "\t".join(cells))
                cells.clear()
        if closing:
            if name in stack:
                while True:
                    classes.pop()
                    if stack.pop() == name:
                        break
        elif not empty and name not in EMPTY and m.start() not in unclosed:
            if name in ("p", "li", "td", "th", "tr") and stack and stack[-1] == name:
                stack.pop()
                classes.pop()
            stack.append(name)
            label = _CLASS.search(attributes)
            classes.append(f".{label[1]}" if label else "")
    take(text[last:])
    yield from flush()
    if cells:
        yield Node("/".join(["html", *stack]), "row", 1, "\t".join(cells))


_LINE_FORMS = (
    ("heading", re.compile(r"^\s{0,3}(\#{1,6})\s+(.*?)\s*\#*\s*$")),
    ("heading", re.compile(r"^\s*(={1,6})\s*([^=].*?)\s*=*\s*$")),
    ("item", re.compile(r"^([*\#:;]+)\s+(.*)$")),
    ("item", re.compile(r"^(\s*)(?:[-+*]|\d{1,3}[.)])\s+(.*)$")),
    ("item", re.compile(r"^(\s*)(?:\\item(?:\[[^\]]*\])?)\s*(.*)$")),
)
_SECTION = re.compile(r"^\s*\\(part|chapter|section|subsection|subsubsection|paragraph)\*?\{(.*)\}\s*$")
_SECTION_LEVEL = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4}


_WIKI_SIGN = re.compile(r"\[\[|\{\{|'''|^=+[^=\n]+=+\s*$|\{\||<ref|__[A-Z]{3,}__", re.M)
_MARKDOWN_SIGN = re.compile(r"\]\(|\*\*|`|~~|^\#{2,6}\s", re.M)


def _line_nodes(text: str, root: str = "", wiki: bool = False) -> Iterator[Node]:
    """Nodes of a text whose structure is in its lines: wiki, Markdown and LaTeX; in wiki text ``#`` counts items."""
    lines = text.split("\n")
    paragraph: list[str] = []
    in_table = in_tabular = False
    cells: list[str] = []

    def flush(kind: str = "text") -> Iterator[Node]:
        if paragraph:
            yield Node(f"{root}/p", kind, 0, "\n".join(paragraph))
            paragraph.clear()

    for i, line in enumerate(lines):
        bare = line.strip()
        if not bare:
            yield from flush()
            continue
        if bare.startswith("{|"):
            yield from flush()
            in_table = True
            continue
        if in_table or _match(r"^\|.*\|$", bare):
            if bare.startswith(("|}", "|-", "|+")) or _fullmatch(r"[|\s:-]+", bare):
                if cells:
                    yield Node(f"{root}/table/row", "row", 1, "\t".join(cells))
                    cells.clear()
                in_table = in_table and not bare.startswith("|}")
                if bare.startswith("|+") and bare[2:].strip():
                    yield Node(f"{root}/table/caption", "text", 0, bare[2:].strip())
                continue
            if bare[0] in "|!":
                yield from flush()
                parts = [p.strip() for p in _split(r"\|\||!!|(?<=.)\|(?=.)", bare.strip("|!"))]
                if in_table:
                    cells.extend(parts)
                else:
                    yield Node(f"{root}/table/row", "row", 1, "\t".join(parts))
                continue
        if _match(r"\\(begin|end)\{(?:tabular|array|longtable)", bare):
            in_tabular = bare.startswith("\\begin")
        elif _search(r"\s&\s.*\\\\\s*(?:\\hline)?$", bare) or (in_tabular and " & " in bare):
            yield from flush()
            yield Node(f"{root}/table/row", "row", 1, "\t".join(_sub(r"\\\\\s*(?:\\hline)?$", "", bare).split(" & ")))
            continue
        if _match(r"^%\s", bare):
            continue
        section = _SECTION.match(line)
        if section:
            yield from flush()
            yield Node(f"{root}/section", "heading", _SECTION_LEVEL[section[1]], section[2])
            continue
        if paragraph and len(paragraph) == 1 and _fullmatch(r"={3,}|-{3,}", bare):
            title = paragraph.pop()
            yield Node(f"{root}/heading", "heading", 1 if bare[0] == "=" else 2, title)
            continue
        if _fullmatch(r"-{3,}|\*{3,}|_{3,}|={3,}", bare):
            yield from flush()
            continue
        if _match(r"^\\(?:begin|end)\{(?:itemize|enumerate|description|center|quote|abstract|document|table|tabular|figure)\}", bare) or _fullmatch(
            r"\\(?:bigskip|medskip|smallskip|newpage|maketitle|centering|hline|noindent)", bare
        ):
            yield from flush()
            continue
        if wiki and line.startswith(" ") and bare[0] not in "*#|{":
            yield from flush()
            yield Node(f"{root}/pre", "code", 0, line[1:].rstrip())
            continue
        for kind, form in _LINE_FORMS[1 if wiki else 0 :]:
            m = form.match(line)
            if m and not (kind == "heading" and form.pattern.startswith(r"^\s*(=") and not m[2].strip()):
                if kind == "item" and m[1].startswith(":") and set(m[1]) == {":"}:
                    line = m[2]
                    break
                yield from flush()
                level = len(m[1]) if kind == "heading" else (len(m[1]) if m[1].strip() else len(m[1]) // 2 + 1)
                yield Node(f"{root}/{kind}", kind, max(1, level), m[2])
                break
        else:
            paragraph.append(_sub(r"^(?:\s{0,3}>\s?|:+\s*)", "", line))
            continue
        if line != lines[i]:
            paragraph.append(line)
    if cells:
        yield Node(f"{root}/table/row", "row", 1, "\t".join(cells))
    yield from flush()


#: A path is boilerplate only below this share of the mean fused ratio.
KEEP_SHARE = 0.1


def content_nodes(nodes: list[Node], keep_share: float = KEEP_SHARE) -> list[Node]:
    """Nodes that are content by their tag-path ratios.

    Per path, tags with their classes: characters per node and punctuation marks per node, each smoothed by a Gaussian over the node
    sequence and scaled by its mean; their product, the median over the path's nodes, is its score.  Text of a path that scores below
    ``keep_share`` of the mean and has no punctuation is boilerplate; below a navigation-like element, and for the items of a menu in
    ``nav``, one of the two is enough.  Headings, other items, rows, captions, code and formulas stay by their kind.
    """
    if not nodes:
        return nodes
    paths = {p: i for i, p in enumerate(dict.fromkeys(n.path for n in nodes))}
    at = np.array([paths[n.path] for n in nodes])
    lengths = np.array([len(n.text) for n in nodes], float)
    punctuation = np.array([len(_PUNCTUATION.findall(n.text)) for n in nodes], float)
    count = np.bincount(at)
    marks = np.bincount(at, punctuation)
    text_ratio = (np.bincount(at, lengths) / count)[at]
    mark_ratio = ((marks + 0.1) / count)[at]
    kernel = np.exp(-0.5 * np.arange(-1, 2) ** 2)
    kernel /= kernel.sum()
    smooth = lambda x: np.convolve(np.pad(x, 1, mode="edge"), kernel, mode="valid")
    text_ratio, mark_ratio = smooth(text_ratio), smooth(mark_ratio)
    score = (text_ratio / text_ratio.mean()) * (mark_ratio / mark_ratio.mean())
    weak = np.array([np.median(score[at == i]) for i in range(len(paths))])[at] < keep_share * score.mean()
    keep = []
    for n, i, low in zip(nodes, at, weak):
        tags = {t.partition(".")[0] for t in n.path.split("/")}
        menu = n.kind == "item" and "nav" in tags
        text = n.kind == "text" and "caption" not in tags and not _KEPT.search(n.text)
        without = not marks[i]
        if (text or menu) and ((low or without) if tags & BOILERPLATE else (low and without)):
            continue
        keep.append(n)
    return keep


def _infobox_rows(m) -> str:
    """The fields of an infobox as rows of a table; fields without value are left out."""
    links = _sub(r"\[\[[^\[\]]*\]\]", lambda g: g.group().replace("|", "\ue004"), m[1])
    fields = (f.partition("=") for f in links.split("|")[1:])
    rows = [f"| {k.strip()} | {v.strip()} |" for k, _, v in fields if v.strip() and "\n" not in v.strip()]
    return "\n" + "\n".join(rows).replace("\ue004", "|") + "\n\n" if not any("\ue004" in x for x in rows) else "\n" + "\n".join(_sub("\\[\\[[^\\[\\]\ue004]*\ue004([^\\[\\]]*)\\]\\]", r"\1", x) for x in rows) + "\n\n"


def clean(text: str, kinds: set[str] | None = None) -> tuple[str, dict[str, int]]:
    """Clean text and the number of headings, items, rows, code blocks and formulas.  A text without markup stays as it is.

    ``kinds`` is the result of ``markup_kinds`` where it is known.
    """
    counts = dict.fromkeys(("heading", "item", "row", "code", "formula"), 0)
    if not (markup_kinds(text) if kinds is None else kinds):
        return text, counts
    if _ESCAPED.search(text):
        text = html.unescape(text)
    ordinary = [m.group() for m in _ORDINARY.finditer(text)]
    hidden = _ORDINARY.sub(lambda m, i=iter(range(len(ordinary))): f"\ue003{next(i)}\ue002", text)
    kept: list[str] = []

    def put_aside(mark: str):
        def replace(m):
            body = next((g for g in reversed(m.groups()) if g is not None), "")
            kept.append(html.unescape(_sub(r"</?code\b[^<>]*>", "", body)).strip("\n"))
            return f"{mark}{len(kept) - 1}\ue002"

        return replace

    for mark, form in _SET_ASIDE:
        hidden = form.sub(put_aside(mark), hidden)
    hidden = _COMMENT.sub("", hidden)
    hidden = _sub(r"<(script|style)\b[^<>]*>.*?</\1\s*>", "", hidden, flags=_SI)
    hidden = _sub(r"<ref\b[^<>]*/>|<ref\b[^<>]*>.*?</ref\s*>", "", hidden, flags=_SI)
    hidden = _sub(r"\{\{\s*Infobox([^{}]*)\}\}", _infobox_rows, hidden, flags=_SI)
    wiki = len(_WIKI_SIGN.findall(text)) > len(_MARKDOWN_SIGN.findall(text))
    nodes = list(_html_nodes(hidden, wiki) if _TAG.search(hidden) else _line_nodes(hidden, "", wiki))
    out: list[str] = []
    for n in content_nodes(nodes):
        body = _inline(n.text) if n.kind != "code" else "    " + html.unescape(n.text)
        body = _sub("\ue003(\\d+)\ue002", lambda m: ordinary[int(m[1])], body)
        counts["code"] += body.count(_CODE)
        counts["formula"] += body.count(_FORMULA)

        def restore(m):
            if m.group()[0] == _FORMULA:
                return f"⟦{kept[int(m[1])].strip()}⟧"
            return "\n" + "\n".join("    " + x for x in kept[int(m[1])].split("\n")) + "\n"

        if n.kind in ("heading", "item"):
            body = " ".join(body.split())
        elif n.kind == "code":
            counts["code"] -= bool(out and out[-1][0] == "code")  # lines of one block
        elif n.kind == "row":
            body = "\t".join(" ".join(c.split()) for c in body.split("\t"))
        else:
            body = "\n".join(_sub(r"[ \t]+", " ", x).strip() for x in body.split("\n")).strip("\n")
        if not body.strip():
            continue
        counts[n.kind] = counts.get(n.kind, 0) + 1
        prefix = {"heading": "§" * n.level + " ", "item": "  " * (n.level - 1) + "• "}.get(n.kind, "")
        body = _KEPT.sub(restore, prefix + body).strip("\n")
        tight = n.kind in ("item", "row", "code") and out and out[-1][0] == n.kind
        out.append((n.kind, ("\n" if tight else "\n\n") + body))
    counts.pop("text", None)
    return "".join(b for _, b in out).strip("\n"), counts


def parsed(text: str) -> tuple[str, str, dict[str, int]]:
    """(kinds of markup, clean text, structure) of a text.

    A text holds markup if its nodes' text differs from it in more than white space: every text is parsed, whether or not a token of
    markup is seen in it.  The tokens only name the kinds, 'other' where none does.  A text without markup stays as it is.
    """
    kinds = markup_kinds(text)
    cleaned, counts = clean(text, kinds or {"other"})
    if cleaned.split() == text.split():
        return "", text, dict.fromkeys(counts, 0)
    return ",".join(sorted(kinds or {"other"})), cleaned, counts


def _solve(text_column: str, id_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [(None, None, {}) if t is None else parsed(t) for t in b.column(text_column).to_pylist()]
            column = lambda name: pa.array([c.get(name, 0) for _, _, c in done], pa.int32())
            yield pa.RecordBatch.from_pydict(
                {
                    id_column: b.column(id_column),
                    "markup": pa.array([k for k, _, _ in done], pa.string()),
                    "clean_text": pa.array([c for _, c, _ in done], pa.string()),
                    "headings": column("heading"), "items": column("item"), "rows": column("row"),
                    "code_blocks": column("code"), "formulas": column("formula"),
                }
            )

    return run


def clean_markup(df: DataFrame, *, id_column: str, text: str) -> DataFrame:
    """(id, markup, clean_text, headings, items, rows, code_blocks, formulas), one row per input row.

    ``markup`` lists the kinds found, '' for none.  A null text gives null markup and text and no structure; an empty text is clean.
    """
    kind = dict(df.dtypes)[id_column]
    schema = f"{id_column} {kind}, markup string, clean_text string, headings int, items int, rows int, code_blocks int, formulas int"
    return spread(df.select(F.col(id_column), F.col(text).alias("__text"))).mapInArrow(_solve("__text", id_column), schema)
