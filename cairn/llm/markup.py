r"""Left-over markup: HTML, Markdown, wiki and LaTeX to clean text with its layout.

Method: layout-aware rendering. Code, comments and formulas are set aside first; wiki, LaTeX and
Markdown constructs become elements; a tree builder with implied tags makes a tree, in which elements
that aren't visible are dropped; the layout walks the tree and keeps block spacing, list items, code,
formulas and aligned table cells. Anything that a stage had to interpret counts as markup.

Not markup: list markers, code in fences and backticks, formulas between dollar signs, and characters
that only resemble markup (comparisons, paths, prices, names with underscores, lone stars or tildes).
The result has none, but for characters that escapes and references spelled out (``\*a\*`` becomes ``*a*``).
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.runtime import spread

#: Element names that make a tag (fixed values: HTML, and what wikis add).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big button cite code data del dfn em font i img input ins kbd label mark meter nobr output progress q rp rt ruby s samp select small span strike strong sub sup textarea time tt u var wbr ref nowiki br".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption colgroup col gallery includeonly noinclude onlyinclude".split()
)
HIDDEN = frozenset("head script style template title meta link base noscript object embed iframe svg canvas audio video source track param area map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TAGS = INLINE | BLOCKS | HIDDEN
#: Attributes that may stand without a value.
BARE = frozenset("hidden open checked disabled selected async defer reversed multiple readonly required controls loop muted autoplay nowrap noshade compact".split())
#: A start tag closes these open elements, up to the element that holds them.
_LISTS, _TABLES = frozenset(("ul", "ol", "menu", "dir")), frozenset(("table",))
IMPLIED = {
    "li": (frozenset(("li",)), _LISTS),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "tr": (frozenset(("td", "th", "tr", "caption")), _TABLES),
    "tbody": (frozenset(("td", "th", "tr", "thead", "tbody", "caption")), _TABLES),
    "thead": (frozenset(("td", "th", "tr", "caption")), _TABLES),
    "tfoot": (frozenset(("td", "th", "tr", "tbody", "thead", "caption")), _TABLES),
    "option": (frozenset(("option",)), frozenset(("select",))),
}
#: Start tags that often follow text at once, as what they end has no end tag.
_LOOSE = frozenset((*IMPLIED, "p"))
_ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

_OPEN, _CLOSE = "\ufdd0", "\ufdd1"
_ATOM = re.compile(_OPEN + r"(\d+)" + _CLOSE)
_NAME = r"[A-Za-z][A-Za-z0-9]*"
_ATTRS = r"(?:\s+[A-Za-z_:@][\w:.@-]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>=`]+))?)*"
_TAG = re.compile(rf"<({_NAME})({_ATTRS})\s*(/?)>|</({_NAME})\s*>")
_END_TAG = re.compile(rf"</({_NAME})")
_ATTR = re.compile(r"([A-Za-z_:@][\w:.@-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'<>=`]+))?")
#: What a line that means something begins with, unless the next one does.
_SPECIAL = frozenset("#>[-*_")
_ENTITY = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")

#: What is set aside, leftmost first.
_ASIDE = re.compile(
    rf"(?=[`~<$\\ \t\d*+\-{_OPEN}{_CLOSE}])(?:"
    r"(?P<fence>^(?P<in>[ \t]*(?:[-*+][ \t]+|\d+[.)][ \t]+)?)(?P<mark>`{3,}|~{3,})[^\n]*(?:\n[\s\S]*?(?:^[ \t]*(?P=mark)[`~]*[ \t]*$|\Z)|\Z))"
    r"|(?P<comment><!--[\s\S]*?(?:-->|\Z))"
    rf"|(?P<raw><(?P<rawname>pre|code|syntaxhighlight|source|nowiki|tt|samp|kbd|math|script|style|xmp|listing)\b(?P<rawattrs>{_ATTRS})\s*>(?P<rawtext>(?:(?!<(?P=rawname)\b)[\s\S])*?)</(?P=rawname)\s*>)"
    r"|(?P<ticks>(?P<t>`+)(?!`)(?:[^`\n]|\n(?!\s*\n)|(?!(?P=t)(?!`))`+)+?(?<!`)(?P=t)(?!`))"
    r"|(?P<dollars>\$\$(?=\S|\n)[\s\S]*?\$\$)"
    r"|(?P<dollar>(?<![\w\\$])\$(?=[^\s$\d]|\d+[^\s\d.,$][^$\n]*\$)(?:[^$\n\\]|\\.|\n(?!\s*\n))*?(?<=[^\s\\])\$(?![\w$]))"
    r"|(?P<env>\\begin\{(?P<envname>equation|align|gather|multline|eqnarray|displaymath|math|verbatim|lstlisting|minted)(?P<star>\*?)\}(?P<envtext>[\s\S]*?)\\end\{(?P=envname)(?P=star)\})"
    r"|(?P<show>\\\[(?P<showtext>[^\n]*?[=^_\\{}][^\n]*?|\n[\s\S]*?)\\\])"
    r"|(?P<short>\\\((?P<shorttext>[^\n]*?)\\\))"
    rf"|(?P<own>[{_OPEN}{_CLOSE}]))",
    re.M | re.I,
)

_LATEX_BARE = frozenset("item hline newpage clearpage noindent centering maketitle tableofcontents linebreak newline par smallskip medskip bigskip quad qquad hfill vfill toprule midrule bottomrule LaTeX TeX ldots dots bf it tt em sc rm textbackslash".split())
_LATEX_HEAD = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
_LATEX_GONE = frozenset("label index vspace hspace bibliographystyle pagestyle documentclass usepackage input include nocite setcounter addtocounter".split())
_LATEX_EDGE = re.compile(r"(?<![\w:\\])~?\\([A-Za-z]+)(\*?)((?:\[[^\]\n]*\])*)\{|[{}\n]")
_TEMPLATE_EDGE = re.compile(r"\{\{|\}\}")
_TEMPLATE = re.compile(r"([A-Za-z#:][^{}|\n]*)((?:\|[^{}]*)?)")
_LINK_EDGE = re.compile(r"[\[\]\n]")
_LINK_TARGET = re.compile(r"\(\s*<?[^()\s]*(?:\([^()\s]*\)[^()\s]*)*>?(?:\s+(?:\"[^\"\n]*\"|'[^'\n]*'))?\s*\)")
_LATEX_WORD = re.compile(r"(?<![\w:\\])\\([A-Za-z]+)(?![A-Za-z\\{\[])")
_ENV = re.compile(r"\\(begin|end)\{([A-Za-z]+)\*?\}(?:\[[^\]\n]*\])?(?:\{[^}\n]*\})?")


class Page:
    """One text on its way: what is set aside, and whether anything was markup."""

    def __init__(self, text: str, title: bool = False):
        self.aside: list[tuple[str, str]] = []
        self.found = 0
        text = text.replace("\r\n", "\n").replace("\r", "\n")
        text = _ASIDE.sub(self._set_aside, text)
        text = self._wiki(text)
        text = self._latex(text)
        text = self._markdown(text, title)
        self.text = self._layout(self._tree(text))

    def atom(self, text: str, kind: str = "inline") -> str:
        self.aside.append((kind, text))
        return f"{_OPEN}{len(self.aside) - 1}{_CLOSE}"

    def mark(self, text: str) -> str:
        self.found += 1
        return text

    # ------------------------------------------------ code, comments, formulas

    def _set_aside(self, m: re.Match) -> str:
        kind = m.lastgroup if m.lastgroup in ("fence", "comment", "raw", "ticks", "dollars", "dollar", "env", "show", "short", "own") else next(k for k in ("fence", "comment", "raw", "ticks", "dollars", "dollar", "env", "show", "short", "own") if m.group(k) is not None)
        if kind in ("fence", "ticks", "dollars", "dollar", "own"):
            return self.atom(m.group(0), "block" if kind == "fence" else "inline")
        self.found += 1
        if kind == "comment":
            return ""
        if kind == "env":
            body, name = m.group("envtext"), m.group("envname").lower()
            if name in ("verbatim", "lstlisting", "minted"):
                return "\n" + self.atom("```\n" + body.strip("\n") + "\n```", "block") + "\n"
            body = re.sub(r"\\label\{[^}]*\}|\\nonumber\b", "", body).strip()
            return "\n" + self.atom(f"$${body}$$", "block") + "\n"
        if kind == "show":
            return "\n" + self.atom(f"$${m.group('showtext').strip()}$$", "block") + "\n"
        if kind == "short":
            body = m.group("shorttext").strip()
            return self.atom(f"${body}$" if re.search(r"[=^_\\{}]|\w", body) else f"({body})")
        name, body = m.group("rawname").lower(), m.group("rawtext")
        if name in ("script", "style"):
            return ""
        if name == "math":
            return self.atom("$" + _formula(body) + "$")
        if name == "nowiki":
            return self.atom(html.unescape(body))
        if name in ("code", "tt", "samp", "kbd") and "\n" not in body:
            return self.atom(_ticks(_stripped(body).strip()))
        language = re.search(r"(?:lang|language)[-=]\s*[\"']?([\w+-]+)", m.group("rawattrs") + body[: body.find(">") + 1])
        return "\n" + self.atom("```" + (language.group(1) if language else "") + "\n" + _stripped(body).strip("\n") + "\n```", "block") + "\n"

    # ------------------------------------------------ wiki

    def _wiki(self, text: str) -> str:
        if "{|" in text:
            text = re.sub(r"^[ \t]*\{\|([\s\S]*?)^[ \t]*\|\}", self._wiki_table, text, flags=re.M)
        if "{{" in text:
            text = self._templates(text)
        if "[[" in text:
            text = re.sub(r"\[\[(?:(?:File|Image|Datei|Fichier):[^\[\]\n]*?\|)?([A-Za-z:/#][^\[\]|\n]*)((?:\|[^\[\]|\n]*)*)\]\]", lambda m: self.mark((m.group(2).rsplit("|", 1)[1] if m.group(2) else m.group(1)).strip()), text)
        if "[http" in text:
            text = re.sub(r"\[(?<![\w\]]\[)(https?://[^\s\]]+)[ \t]+([^\]\n]+)\]", lambda m: self.mark(m.group(2)), text)
        if "''" in text:
            text = re.sub(r"('{2,5})(?=[^\s'])([^'\n]+?)(?<=[^\s'])\1(?!')", lambda m: self.mark(m.group(2)), text)
        if "==" in text:
            text = re.sub(r"^[ \t]*(={2,6})[ \t]*(?=[^=\s])(.*?\S)[ \t]*\1[ \t]*$", lambda m: self.mark(f"<h{len(m.group(1))}>{m.group(2)}</h{len(m.group(1))}>"), text, flags=re.M)
        if "TOC__" not in text and "__NO" not in text:
            return text
        return re.sub(r"^[ \t]*__(?:TOC|NOTOC|FORCETOC|NOEDITSECTION)__[ \t]*$", lambda m: self.mark(""), text, flags=re.M)

    def _templates(self, text: str) -> str:
        """Templates, which may hold templates: the innermost first, in one pass with a stack of what is open."""
        stack: list[list[str]] = [[]]
        at = 0
        for m in _TEMPLATE_EDGE.finditer(text):
            stack[-1].append(text[at : m.start()])
            at = m.end()
            if m.group() == "{{":
                stack.append([])
            elif len(stack) == 1:
                stack[0].append("}}")
            else:
                inner = "".join(stack.pop())
                whole = _TEMPLATE.fullmatch(inner)
                stack[-1].append(self._template(whole) if whole else "{{" + inner + "}}")
        stack[-1].append(text[at:])
        return "{{".join(map("".join, stack))

    def _template(self, m: re.Match) -> str:
        args = [a.strip() for a in m.group(2).split("|")[1:]]
        return self.mark(", ".join(a for a in args if a and "=" not in a))

    def _wiki_table(self, m: re.Match) -> str:
        self.found += 1
        rows, row = [], []
        for line in m.group(1).split("\n")[1:]:
            line = line.strip()
            if line.startswith("|-"):
                if row:
                    rows.append(row)
                row = []
            elif line.startswith("|+"):
                rows.append([("td", line[2:].strip())])
            elif line[:1] in ("|", "!"):
                tag = "th" if line[0] == "!" else "td"
                for cell in re.split(r"\|\||!!" if tag == "th" else r"\|\|", line[1:]):
                    style, bar, rest = cell.partition("|")
                    row.append((tag, (rest if bar and "=" in style and "[[" not in style else cell).strip()))
            elif line and row:
                row[-1] = (row[-1][0], row[-1][1] + " " + line)
        if row:
            rows.append(row)
        return "<table>" + "".join("<tr>" + "".join(f"<{t}>{c}</{t}>" for t, c in r) + "</tr>" for r in rows) + "</table>"

    # ------------------------------------------------ LaTeX

    def _latex(self, text: str) -> str:
        if "\\" not in text:
            return text
        if "\\begin{tabular" in text:
            text = re.sub(r"\\begin\{tabular\*?\}(?:\[[^\]]*\])?(?:\{[^}]*\})+([\s\S]*?)\\end\{tabular\*?\}", self._tabular, text)
        lists = {"itemize": "ul", "enumerate": "ol", "description": "ul"}
        text = _ENV.sub(lambda m: self.mark(f"<{'/' * (m.group(1) == 'end')}{lists[m.group(2)]}>" if m.group(2) in lists else ""), text)
        text = re.sub(r"\\item(?![A-Za-z])[ \t]*(?:\[([^\]\n]*)\])?[ \t]*", lambda m: self.mark("<li>" + (m.group(1) + " " if m.group(1) else "")), text)
        text = self._commands(text)
        return _LATEX_WORD.sub(lambda m: self.mark({"ldots": "…", "dots": "…", "LaTeX": "LaTeX", "TeX": "TeX", "quad": " ", "qquad": " ", "newline": "\n", "linebreak": "\n", "par": "\n\n"}.get(m.group(1), "")) if m.group(1) in _LATEX_BARE else m.group(0), text)

    def _commands(self, text: str) -> str:
        """Commands with arguments, which may hold commands: one pass with a stack of open braces. An argument ends in its line."""
        # an open brace: (what stood before it, the command that it belongs to or None, the arguments before it, what it holds so far)
        stack: list[tuple[str, re.Match | None, list[str], list[str]]] = [("", None, [], [])]
        at = 0

        def flat() -> None:
            """What is open isn't closed: it stays as it is."""
            while len(stack) > 1:
                before, _, args, held = stack.pop()
                stack[-1][3].append(before + "".join("{" + a + "}" for a in args) + "{" + "".join(held))

        for m in _LATEX_EDGE.finditer(text):
            if m.start() < at:
                continue
            stack[-1][3].append(text[at : m.start()])
            at = m.end()
            edge = m.group()
            if edge == "\n":
                flat()
                stack[0][3].append(edge)
            elif edge == "}":
                if len(stack) == 1:
                    stack[0][3].append(edge)
                    continue
                before, command, args, held = stack.pop()
                inner = "".join(held)
                if command is None:
                    stack[-1][3].append("{" + inner + "}")
                elif text.startswith("{", at):
                    stack.append((before, command, [*args, inner], []))
                    at += 1
                else:
                    stack[-1][3].append(self._command(command, [*args, inner]))
            elif edge == "{":
                stack.append(("", None, [], []))
            else:
                stack.append((edge[:-1], m, [], []))
        stack[-1][3].append(text[at:])
        flat()
        return "".join(stack[0][3])

    def _command(self, m: re.Match, args: list[str]) -> str:
        self.found += 1
        name, option = m.group(1), m.group(3)[1:-1].replace("~", " ")
        lead = " " if m.group(0).startswith("~") else ""
        if name in _LATEX_HEAD:
            return f"<h{_LATEX_HEAD[name]}>{args[0]}</h{_LATEX_HEAD[name]}>" + "".join(args[1:])
        if name in _LATEX_GONE:
            return lead
        if re.fullmatch(r"[a-z]*cite[a-z]*", name):
            return f"{lead}[{args[0]}{', ' + option if option else ''}]"
        if re.fullmatch(r"(?:eq|auto|c|page|name)?ref", name):
            return f"{lead}({args[0]})"
        if name == "href":
            return lead + args[-1]
        if name == "footnote":
            return f"{lead} ({args[0]})"
        return lead + " ".join(a for a in args if a)

    def _tabular(self, m: re.Match) -> str:
        self.found += 1
        rows = [r for r in re.split(r"\\\\(?:\[[^\]]*\])?", re.sub(r"\\(?:hline|toprule|midrule|bottomrule)\b", "", m.group(1))) if r.strip()]
        return "<table>" + "".join("<tr>" + "".join(f"<td>{c.strip()}</td>" for c in re.split(r"(?<!\\)&", r)) + "</tr>" for r in rows) + "</table>"

    # ------------------------------------------------ Markdown

    def _markdown(self, text: str, title: bool) -> str:
        if title:
            text = re.sub(r"[ \t]+#+[ \t]*$", lambda m: self.mark(""), text)
        if "{#" in text or "{." in text or "{:" in text or "{ " in text:
            text = re.sub(r"[ \t]*(?<!\{)\{:?[ \t]*(?:[#.][A-Za-z][\w:-]*[ \t]*)+\}", lambda m: self.mark(""), text)
        text = self._lines(text)
        if "![" in text:
            text = re.sub(r"!\[([^\]\n]*)\]\(\s*<?[^()\s]*(?:\([^()\s]*\)[^()\s]*)*>?(?:\s+(?:\"[^\"\n]*\"|'[^'\n]*'))?\s*\)", lambda m: self.mark(m.group(1)), text)
        if "](" in text:
            text = self._links(text)
        if "][" in text:
            text = re.sub(r"(?<![\w\]\\])!?\[([^\[\]\n]+)\]\[([^\[\]\n^]*)\](?!\()", lambda m: self.mark(m.group(1)), text)
        if "[^" in text:
            text = re.sub(r"\[\^([^\]\s]+)\]", lambda m: self.mark(f"[{m.group(1)}]"), text)
        if "<" in text:
            text = re.sub(r"<((?:https?|ftp|mailto):[^\s<>]+|[\w.+-]+@[\w-]+\.[\w.]+)>", lambda m: self.mark(self.atom(m.group(1))), text)
        # escapes are characters, so they are set aside before emphasis is looked for
        if "\\" in text:
            text = re.sub(r"\\(?<![\\:]\\)([!-/:-@\[\]-`{-~])", lambda m: self.mark(self.atom(m.group(1))), text)
        for stars in ("***", "**", "*"):
            if text.count(stars) < 2:
                continue
            s = re.escape(stars)
            text = re.sub(rf"{s}(?<![\w*]{s})(?=[^\s*])((?:[^*\n]|\n(?![ \t]*\n|[ \t]*[*+-][ \t]))+?)(?<=[^\s*]){s}(?![\w*])", lambda m: self.mark(m.group(1)), text)
        if text.count("__") > 1:
            text = re.sub(r"__(?<!\w__)(?=[^\s_])([^_\n]*[^\S\n][^_\n]*)(?<=[^\s_])__(?!\w)", lambda m: self.mark(m.group(1)), text)
        if text.count("_") > 1:
            text = re.sub(r"_(?<!\w_)(?=[^\s_])((?:[^_\n]|\n(?![ \t]*\n|[ \t]*[*+-][ \t]))+?)(?<=[^\s_])_(?!\w)", lambda m: self.mark(m.group(1)), text)
        if text.count("~~") < 2:
            return text
        return re.sub(r"~~(?=[^\s~])([^~\n]+?)(?<=[^\s~])~~", lambda m: self.mark(m.group(1)), text)

    def _links(self, text: str) -> str:
        """Links, whose texts may hold brackets and links: one pass with a stack of open brackets. A text ends in its line."""
        stack: list[tuple[bool, list[str]]] = [(False, [])]
        at = 0

        def flat() -> None:
            while len(stack) > 1:
                held = stack.pop()[1]
                stack[-1][1].append("[" + "".join(held))

        for m in _LINK_EDGE.finditer(text):
            if m.start() < at:
                continue  # in a target
            stack[-1][1].append(text[at : m.start()])
            at = m.end()
            edge = m.group()
            if edge == "\n":
                flat()
                stack[0][1].append(edge)
            elif edge == "[":
                before = text[m.start() - 1] if m.start() else ""
                stack.append((not (before and (before.isalnum() or before in "_]\\")), []))
            elif len(stack) == 1:
                stack[0][1].append(edge)
            else:
                able, held = stack.pop()
                inner = "".join(held)
                target = _LINK_TARGET.match(text, at) if able else None
                if target:
                    at = target.end()
                stack[-1][1].append(self.mark(inner) if target else "[" + inner + "]")
        stack[-1][1].append(text[at:])
        flat()
        return "".join(stack[0][1])

    def _lines(self, text: str) -> str:
        lines, out, i = text.split("\n"), [], 0
        rule = re.compile(r"^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$")
        while i < len(lines):
            line = lines[i]
            following = lines[i + 1] if i + 1 < len(lines) else ""
            if "|" not in line and line.lstrip()[:1] not in _SPECIAL and following.lstrip()[:1] not in ("=", "-"):
                out.append(line)
                i += 1
                continue
            if "|" in line and "|" in following and rule.match(following):
                j = i
                while j < len(lines) and "|" in lines[j]:
                    j += 1
                out.append(self._pipe_table(lines[i:j]))
                i = j
                continue
            if re.match(r"^[ \t]*\|.*\|[ \t]*$", line) and line.count("|") >= 3 or "|" in line and rule.match(line) and line.strip().startswith("|"):
                j = i
                while j < len(lines) and re.match(r"^[ \t]*\|.*\|[ \t]*$", lines[j]):
                    j += 1
                out.append(self._pipe_table(lines[i : max(j, i + 1)]))
                i = max(j, i + 1)
                continue
            m = re.match(r"^[ ]{0,3}(#{1,6})[ \t]+(.*?)(?:[ \t]+#+)?[ \t]*$", line)
            if m and m.group(2) and not (re.match(r"^[ \t]*(?:#|[*:;])[#*:;]*[ \t]", following) or i and re.match(r"^[ \t]*[*:;#][#*:;]*[ \t]", lines[i - 1])):
                out.append(self.mark(f"<h{len(m.group(1))}>{m.group(2)}</h{len(m.group(1))}>"))
                i += 1
                continue
            if line.strip() and re.match(r"^[ ]{0,3}=+[ \t]*$|^[ ]{0,3}-{3,}[ \t]*$", following) and not re.match(r"^[ \t]*(?:[-*+>]|\d+[.)])[ \t]", line):
                level = 1 if "=" in following else 2
                out.append(self.mark(f"<h{level}>{line.strip()}</h{level}>"))
                i += 2
                continue
            if re.match(r"^[ ]{0,3}(?:-{3,}|\*{3,}|_{3,}|(?:- ){2,}-|(?:\* ){2,}\*)[ \t]*$", line):
                out.append(self.mark("<hr>"))
                i += 1
                continue
            m = re.match(r"^[ ]{0,3}(?:>[ \t]?)+(.*)$", line)
            if m:
                out.append(self.mark(m.group(1)))
                i += 1
                continue
            m = re.match(r"^[ ]{0,3}\[\^([^\]\s]+)\]:[ \t]*(.*)$", line)
            if m:
                out.append(self.mark(f"[{m.group(1)}] {m.group(2)}"))
                i += 1
                continue
            if re.match(r"^[ ]{0,3}\[[^\]\n^]+\]:[ \t]*(?:<[^>\n]*>|(?:https?:|ftp:|mailto:|[/.#])\S*)(?:[ \t]+(?:\"[^\"\n]*\"|'[^'\n]*'|\([^)\n]*\)))?[ \t]*$", line):
                self.found += 1  # a link's target isn't visible
                i += 1
                continue
            out.append(line)
            i += 1
        return "\n".join(out)

    def _pipe_table(self, lines: list[str]) -> str:
        self.found += 1
        rows = []
        for line in lines:
            line = line.strip()
            if re.fullmatch(r"\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?", line):
                continue
            cells = re.split(r"(?<!\\)\|", line.removeprefix("|").removesuffix("|"))
            rows.append("<tr>" + "".join(f"<td>{c.strip()}</td>" for c in cells) + "</tr>")
        return "<table>" + "".join(rows) + "</table>"

    # ------------------------------------------------ tree

    def _tree(self, text: str) -> list:
        root: list = ["#root", {}, []]
        stack = [root]
        opened: Counter = Counter()
        at = deepest = 0
        last: dict[str, int] | None = None  # where the last end tag of a name is

        def close_from(k: int) -> None:
            for node in stack[k:]:
                opened[node[0]] -= 1
            del stack[k:]

        def put(s: str) -> None:
            if s:
                if "&" in s:
                    s = _ENTITY.sub(lambda m: self.mark(self.atom(html.unescape(m.group(0)))) if m.group(0)[1] == "#" or m.group(0)[1:] in html5 else m.group(0), s)
                stack[-1][2].append(s)

        for m in _TAG.finditer(text):
            name = (m.group(1) or m.group(4)).lower()
            attrs = {a.lower(): v.strip("\"'") for a, v in _ATTR.findall(m.group(2) or "")}
            if name not in TAGS or any(not v and a not in BARE for a, v in attrs.items()):
                continue
            close = bool(m.group(4))
            if not close and not attrs and name not in VOID and name not in _LOOSE and m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_"):
                if last is None:
                    last = {e.group(1).lower(): e.start() for e in _END_TAG.finditer(text)}
                if last.get(name, -1) < m.end():
                    continue  # a type with a parameter
            put(text[at : m.start()])
            at = m.end()
            self.found += 1
            if close:
                for k in range(len(stack) - 1, 0, -1) if opened[name] else ():
                    if stack[k][0] == name:
                        close_from(k)
                        break
                    if name in INLINE and stack[k][0] in BLOCKS:
                        break
                continue
            if name in IMPLIED:
                ends, holders = IMPLIED[name]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in holders and stack[k][0] not in ends:
                        break
                    if stack[k][0] in ends:
                        close_from(k)
                        if name not in ("tr", "tbody", "tfoot", "thead"):
                            break
            elif name in _ENDS_P and opened["p"]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        close_from(k)
                        break
                    if stack[k][0] in BLOCKS:
                        break
            if name in ("td", "th") and stack[-1][0] in ("table", "tbody", "thead", "tfoot"):
                row: list = ["tr", {}, []]  # an implied row
                stack[-1][2].append(row)
                stack.append(row)
                opened["tr"] += 1
            node: list = [name, attrs, []]
            stack[-1][2].append(node)
            if name not in VOID and not m.group(3):
                stack.append(node)
                opened[name] += 1
                deepest = max(deepest, len(stack))
        put(text[at:])
        if (frames := 4 * deepest + 1000) > sys.getrecursionlimit():
            sys.setrecursionlimit(frames)  # the layout walks the tree by plain calls, which take no room on the machine's stack
        return root

    # ------------------------------------------------ layout

    def _layout(self, root: list) -> str:
        text = self._render(root, 0)
        text = _ATOM.sub(lambda m: self._restored(int(m.group(1))), text)
        text = re.sub(r"[ \t]+\n", "\n", text)
        return re.sub(r"\n{3,}", "\n\n", text).strip()

    def _restored(self, k: int) -> str:
        return _ATOM.sub(lambda m: self._restored(int(m.group(1))), self.aside[k][1])

    @staticmethod
    def _visible(node: list) -> bool:
        style = node[1].get("style", "").replace(" ", "").lower()
        return node[0] not in HIDDEN and "hidden" not in node[1] and "display:none" not in style and "visibility:hidden" not in style

    def _render(self, node: list, depth: int) -> str:
        out = []
        for child in node[2]:
            if isinstance(child, str):
                out.append(child)
                continue
            if not self._visible(child):
                continue
            name = child[0]
            if name == "br":
                out.append("\n")
            elif name == "hr":
                out.append("\n\n")
            elif name == "img":
                out.append(child[1].get("alt", ""))
            elif name in ("ul", "ol", "menu", "dir"):
                out.append("\n" + self._list(child, depth) + "\n")
            elif name == "table":
                out.append("\n" + self._table(child, depth) + "\n")
            elif name == "li":
                out.append("\n- " + self._flat(child, depth) + "\n")
            elif name == "dt":
                out.append("\n" + self._flat(child, depth) + "\n")
            elif name == "dd":
                out.append("\n  " + self._flat(child, depth) + "\n")
            elif name == "ref":
                inner = self._flat(child, depth)
                out.append(f" ({inner})" if inner else "")
            elif name == "q":
                out.append('"' + self._render(child, depth) + '"')
            elif name in ("summary", "figcaption", "caption", "option", "legend", "tr"):
                out.append("\n" + self._render(child, depth).strip() + "\n")
            elif name in ("td", "th"):
                out.append(self._flat(child, depth) + "  ")
            elif name in BLOCKS:
                out.append("\n\n" + self._render(child, depth).strip("\n") + "\n\n")
            else:
                out.append(self._render(child, depth))
        return "".join(out)

    def _flat(self, node: list, depth: int) -> str:
        """The text of an item or cell: its own text on one line, nested blocks below it."""
        text = self._render(node, depth + 1).strip()
        head, *rest = re.split(r"\n+", text)
        return "\n".join([" ".join(head.split()), *rest]) if rest else " ".join(head.split())

    def _list(self, node: list, depth: int) -> str:
        lines, n = [], 0
        for child in node[2]:
            if isinstance(child, str):
                lines += [x.strip() for x in child.split("\n") if x.strip()]
                continue
            if not self._visible(child):
                continue
            body = self._flat(child, depth)
            if not body:
                continue
            if child[0] == "li":
                n += 1
                marker = f"{n}. " if node[0] == "ol" else "- "
                first, *rest = body.split("\n")
                lines.append(marker + first)
                lines += ["  " + x for x in rest if x.strip()]
            else:
                lines += ["  " + x for x in body.split("\n") if x.strip()]
        return "\n".join(lines)

    def _table(self, node: list, depth: int) -> str:
        rows: list[list[str]] = []
        notes: list[str] = []

        def walk(n: list) -> None:
            for child in n[2]:
                if isinstance(child, str):
                    if child.strip():
                        notes.append(" ".join(child.split()))
                elif not self._visible(child):
                    continue
                elif child[0] == "tr":
                    rows.append([" ".join(self._flat(c, depth).split()) for c in child[2] if not isinstance(c, str) and self._visible(c)])
                elif child[0] in ("tbody", "thead", "tfoot", "colgroup"):
                    walk(child)
                else:
                    notes.append(self._flat(child, depth))

        walk(node)
        shown = lambda c: _ATOM.sub(lambda m: self._restored(int(m.group(1))), c)
        width = [max((len(shown(r[k])) for r in rows if k < len(r)), default=0) for k in range(max(map(len, rows), default=0))]
        lines = ["  ".join(c + " " * (width[k] - len(shown(c))) for k, c in enumerate(r)).rstrip() for r in rows if any(r)]
        return "\n".join([*(x for x in notes if x), *lines])


def _stripped(code: str) -> str:
    return html.unescape(_TAG.sub(lambda m: "" if (m.group(1) or m.group(4)).lower() in TAGS else m.group(0), code))


def _ticks(code: str) -> str:
    fence = "`" * (max((len(x) for x in re.findall(r"`+", code)), default=0) + 1)
    return f"{fence} {code} {fence}" if "`" in code else f"`{code}`" if code else ""


_MATH_TAG = re.compile(r"<(/?)(m[a-z]+)\b[^>]*?(/?)>")
_MATH_PAIRS = {"msub": "{}_{{{}}}", "msup": "{}^{{{}}}", "mfrac": "\\frac{{{}}}{{{}}}"}
_MATH_LEAVES = frozenset(("mi", "mn", "mo", *_MATH_PAIRS))


def _formula(body: str) -> str:
    """MathML or TeX in a math element as one line of TeX-like text."""
    stack: list[tuple[str, list[tuple[str, str]]]] = [("", [])]
    at = 0

    def close() -> None:
        name, kids = stack.pop()
        texts = [x for _, x in kids]
        if name in _MATH_PAIRS and len(kids) == 2 and all(k for k, _ in kids):
            stack[-1][1].append((name, _MATH_PAIRS[name].format(*texts)))
        elif name == "mrow" and all(k in _MATH_LEAVES or k == "mrow" for k, _ in kids):
            stack[-1][1].append(("mrow", "".join(texts)))
        else:
            stack[-1][1].append((name, " ".join(texts)))

    for m in _MATH_TAG.finditer(body):
        if (text := " ".join(body[at : m.start()].split())):
            stack[-1][1].append(("", text))
        at = m.end()
        if m.group(1):
            if len(stack) > 1 and stack[-1][0] == m.group(2):
                close()
        elif not m.group(3):
            stack.append((m.group(2), []))
    if (text := " ".join(body[at:].split())):
        stack[-1][1].append(("", text))
    while len(stack) > 1:
        close()
    return html.unescape(" ".join(x for _, x in stack[0][1] if x))


def render(text: str, title: bool = False) -> tuple[str, int]:
    """(the clean text, how many pieces of markup there were)."""
    page = Page(text, title)
    return page.text, page.found


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        bodies, paths, in_body, in_path = [], [], [], []
        for text, path in zip(b.column("section_text").to_pylist(), b.column("heading_path").to_pylist()):
            body, n = render(text) if text is not None else (None, 0)
            titles = None if path is None else [(None, 0) if t is None else render(t, True) for t in path]
            bodies.append(body)
            paths.append(None if titles is None else [t for t, _ in titles])
            in_body.append(n)
            in_path.append(sum(k for _, k in titles or []))
        yield pa.record_batch([b.column("rec_id"), pa.array(bodies, pa.string()), pa.array(paths, pa.list_(pa.string())), pa.array(in_body, pa.int32()), pa.array(in_path, pa.int32())], names=["rec_id", "section_text", "heading_path", "in_text", "in_path"])


def clean_sections(sections: DataFrame) -> DataFrame:
    """(rec_id, section_text, heading_path, in_text, in_path): each row rendered, with the numbers of pieces of markup.

    Null texts, paths and titles stay null, blank ones become empty. Rows repeated whole come out as often.
    Sections are independent: there is no shuffle, and extra columns never leave the scan.
    """
    rows = sections.select(F.col("rec_id").cast("bigint").alias("rec_id"), F.col("section_text").cast("string").alias("section_text"), F.col("heading_path").cast("array<string>").alias("heading_path"))
    return spread(rows).mapInArrow(_rendered, "rec_id bigint, section_text string, heading_path array<string>, in_text int, in_path int")


def marked_fields(sections: DataFrame) -> DataFrame:
    """(rec_id, field): the fields in which the renderer met markup."""
    fields = F.filter(F.array(F.when(F.col("in_text") > 0, F.lit("section_text")), F.when(F.col("in_path") > 0, F.lit("heading_path"))), lambda x: x.isNotNull())
    return clean_sections(sections).select("rec_id", F.explode(fields).alias("field"))
