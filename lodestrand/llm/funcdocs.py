"""Functions paired with their documentation, from the code text of entities.

A string- and comment-aware state machine splits the code into pieces; braces are matched to delimit functions and methods, and
the documentation comment directly above each is attached to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import newest_rows

# The states of the lexer. In code, a piece is a name, a number, a line end or a sign, or opens another state.
_CODE = re.compile(r"""(?P<line>//)|(?P<block>/\*)|(?P<raw>\b(?:u8|[uUL])?R"(?=[^()\\\s]{0,16}\())|(?P<str>")|(?P<chr>(?<![0-9a-fA-F])')|(?P<dir>^[ \t]*\#)|(?P<name>[^\W\d]\w*)|(?P<num>\d(?:[\w.]|'\w)*)|(?P<nl>\n)|(?P<op>::|\[\[|\]\]|->|[^\s])""", re.M)
# How each other state ends: with its sign, or where the line or the text does.
_REST = {
    "line": re.compile(r"(?:[^\n\\]|\\.|\\\n)*", re.S),
    "block": re.compile(r".*?(?:\*/|\Z)", re.S),
    "raw": re.compile(r"([^()\\\s]{0,16})\(.*?(?:\)\1\"|\Z)", re.S),
    "str": re.compile(r"(?:[^\"\\\n]|\\.|\\\n)*(?:\"|(?=\n)|\Z)", re.S),
    "chr": re.compile(r"(?:[^'\\\n]|\\.)*(?:'|(?=\n)|\Z)", re.S),
    "dir": re.compile(r"(?:[^\n\\]|\\.|\\\n)*", re.S),
}
_DOXYGEN = re.compile(r"/\*\*(?!/)|/\*!|///|//!")
_TYPES = {"class", "struct", "union", "enum", "namespace"}
_NOT_NAMES = {"if", "for", "while", "switch", "catch", "return", "sizeof", "alignas", "decltype", "noexcept", "__attribute__", "__declspec", "explicit", "requires", "throw", "static_assert", "new", "delete", "else", "do", "try"}


class _Piece:
    __slots__ = ("kind", "text", "start", "end", "line", "last")

    def __init__(self, kind, text, start, end, line, last):
        self.kind, self.text, self.start, self.end, self.line, self.last = kind, text, start, end, line, last


def _pieces(code: str) -> list[_Piece]:
    """The pieces of a text: a state machine that is in code, a comment, a string, a character or a directive."""
    out, line, at, n = [], 0, 0, len(code)
    while at < n:
        begun, at = at, n
        for m in _CODE.finditer(code, begun):  # in code, until something opens
            kind = m.lastgroup
            if kind in _REST:
                start, at = m.start(), _REST[kind].match(code, m.end()).end()
                text = code[start:at]
                last = line if kind == "chr" else line + text.count("\n")
                out.append(_Piece(kind, text, start, at, line, last))
                line = last
                break
            if kind == "nl":
                line += 1
            else:
                out.append(_Piece(kind, m.group(), m.start(), m.end(), line, line))
    return out


def _match(p: list[_Piece], i: int, open_: str, close: str) -> int:
    """Index of the piece that closes the bracket at ``i``, or the number of pieces."""
    depth = 0
    for j in range(i, len(p)):
        if p[j].kind == "op":
            if p[j].text == open_:
                depth += 1
            elif p[j].text == close:
                depth -= 1
                if not depth:
                    return j
    return len(p)


def _function_name(head: list[_Piece]) -> str | None:
    """The bare name before the parameter list of a definition's head, or None if the head is no function's."""
    k = 0
    while k < len(head):
        t = head[k].text
        if t == "template" and k + 1 < len(head) and head[k + 1].text == "<":
            depth, k = 0, k + 1
            while k < len(head):
                depth += (head[k].text == "<") - (head[k].text == ">")
                k += 1
                if not depth:
                    break
            continue
        if t == "[[":
            k = _match(head, k, "[[", "]]") + 1
            continue
        if t == "operator":
            j = k + 1
            if j + 1 < len(head) and head[j].text == "(" and head[j + 1].text == ")":
                return "operator()"
            while j < len(head) and head[j].text != "(":
                j += 1
            words = [x.text for x in head[k + 1 : j]]
            return "operator" + (" " if words and words[0][0].isalpha() else "") + "".join(words) if j < len(head) else None
        if t == "=" and head[k].kind == "op":
            return None
        if t == "(":
            name = head[k - 1] if k else None
            if name is None or name.kind != "name":
                if name is not None and name.text == ">":  # a template-id before the parameters
                    depth, j = 0, k - 1
                    while j >= 0:
                        depth += (head[j].text == ">") - (head[j].text == "<")
                        if not depth:
                            break
                        j -= 1
                    if j > 0 and head[j - 1].kind == "name":
                        return head[j - 1].text
                return None
            if name.text in _NOT_NAMES or (name.text.isupper() and k + 1 < len(head) and _match(head, k, "(", ")") + 1 < len(head) and head[_match(head, k, "(", ")") + 1].kind == "name" and "(" in [x.text for x in head[_match(head, k, "(", ")") + 1 :]]):
                k = _match(head, k, "(", ")") + 1
                continue
            return "~" + name.text if k > 1 and head[k - 2].text == "~" else name.text
        k += 1
    return None


def _is_type(head: list[_Piece]) -> bool:
    """Whether the head is that of a class, struct, union, enum, namespace or linkage block."""
    depth = 0
    for i, x in enumerate(head):
        if x.text == "<":
            depth += 1
        elif x.text == ">":
            depth -= 1
        elif not depth and x.kind == "name" and x.text in _TYPES:
            return not any(y.text == "(" and (j == i + 1 or head[j - 1].text not in ("alignas", "__attribute__", "__declspec")) for j, y in enumerate(head) if j > i) or x.text == "namespace"
        elif x.text == "extern" and i + 1 < len(head) and head[i + 1].kind == "str":
            return i + 2 == len(head)
        elif x.text == "(":
            return False
    return False


def documented_functions(code: str) -> Iterator[tuple[str, str, str]]:
    """(name, code from head to closing brace, comment above or "") of every function with a body outside other functions."""
    p = _pieces(code)
    i, head, notes, fresh = 0, [], [], -1
    while i < len(p):
        x = p[i]
        if x.kind in ("line", "block"):
            if not head and x.line != fresh:  # a comment behind code on the same line belongs to that code
                notes.append(x)
            i += 1
            continue
        if x.kind == "dir":
            head, notes = [], []
            fresh, i = x.last, i + 1
            continue
        if x.text in ("(", "[") and x.kind == "op":
            j = min(_match(p, i, x.text, ")" if x.text == "(" else "]"), len(p) - 1)
            head += [y for y in p[i : j + 1] if y.kind not in ("line", "block")]
            fresh, i = p[j].last, j + 1
            continue
        if x.kind == "op" and x.text == "{":
            name = None if _is_type(head) else _function_name(head)
            if name and head and head[-1].kind == "name" and any(y.text == ":" for y in head) and head[-1].text not in ("const", "noexcept", "override", "final", "mutable", "volatile", "try"):
                j = _match(p, i, "{", "}")  # a member initialised with braces
                head += p[i : j + 1]
                i = j + 1
                continue
            if name:
                j = _match(p, i, "{", "}")
                end = p[min(j, len(p) - 1)]
                yield name, code[head[0].start : end.end], _above(notes, head[0].line)
                head, notes = [], []
                fresh, i = end.last, j + 1
                continue
            if _is_type(head) and not any(y.text == "enum" for y in head):
                head, notes = [], []  # its members follow
                fresh, i = x.last, i + 1
                continue
            j = _match(p, i, "{", "}")
            head += p[i : i + 1]
            fresh, i = p[min(j, len(p) - 1)].last, j + 1
            continue
        if x.kind == "op" and x.text in (";", "}"):
            head, notes = [], []
        elif x.text == ":" and len(head) == 1 and head[0].text in ("public", "private", "protected"):
            head, notes = [], []
        else:
            head.append(x)
        fresh, i = x.last, i + 1


def _above(notes: list[_Piece], line: int) -> str:
    """The documentation comments of the run of comments that ends right above ``line``."""
    run: list[str] = []
    for x in reversed(notes):
        if line - x.last > 1:
            break
        if _DOXYGEN.match(x.text) and not x.text.startswith(("///<", "//!<", "/**<", "/*!<")):
            run.append(x.text)
        line = x.line
    return "\n".join(reversed(run))


_TAG = re.compile(r"[@\\](param(?:\s*\[[^\]]*\])?\s+\S+|tparam\s+\S+|retval\s+\S+|throws?\s+\S+|exception\s+\S+|\w+)")
_ELSEWHERE = re.compile(
    r"[@\\](?:copydoc|copybrief|copydetails|see|sa|ref|link|todo)\b|\b(?:todo|fixme|xxx|tbd|tba|wip)\b|^\s*(?:see|refer to|cf\.?|same as above|as above|ditto|inherited|documented)\b.{0,60}$"
    r"|\b(?:undocumented|not documented|no (?:\w+ )?(?:documentation|description|comment)\b|placeholder\b|(?:\w+ )?(?:documentation|description|comment|text|summary) (?:goes|comes|belongs) here|needs? (?:a )?(?:doc\w*|description|comment)|missing (?:doc\w*|description|comment)|(?:doc\w*|description|comment|text) (?:is |are )?(?:still )?(?:missing|pending|to follow|to come|to be|not (?:yet )?(?:available|written))"
    r"|to be (?:documented|described|written|done|added|filled in|completed|defined)|add (?:a )?(?:doc\w*|description|comment)|document (?:this|me|it)|describe (?:this|me|what)|write (?:this|me|doc\w*)|fill (?:this )?in|(?:documented|described) (?:in|at|elsewhere)|see (?:the )?(?:header|base|parent|above|below|implementation|declaration|interface|wiki|docs?|documentation))\b",
    re.I,
)
_LICENCE = re.compile(r"\bcopyright\b|\(c\)\s*\d{4}|\ball rights reserved\b|\blicen[cs]ed? (?:under|file)\b|\bspdx-license|\bpermission is hereby granted\b|\bredistribution and use\b|\bwithout warrant", re.I)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_HAN = re.compile(r"[㐀-䶿一-鿿぀-ヿ]")
_CODE_LINE = re.compile(r"[;{}]\s*(?://.*)?$|^\s*(?:if|for|while|switch|return|else|case|const|auto|int|void|bool|#\s*\w+)\b.*[({;:]\s*$|^\s*[\w.>\-\[\]]+\s*(?:[+\-*/|&^]?=)\s*[^=]")


def clean_comment(text: str) -> str:
    """Comment text without its markers, one line per line, blank lines left out."""
    out = []
    for k, s in enumerate(text.splitlines()):
        s = s.strip()
        s = re.sub(r"^(?:/\*\*+|/\*!|///+|//!|//)<?", "", s)
        s = re.sub(r"\*+/$", "", s).strip()
        if not re.match(r"/\*", s):
            s = re.sub(r"^\*+(?!\w)", "", s) if k or s.startswith("* ") else s
        if s.strip():
            out.append(s.strip())
    return "\n".join(out)


def trivial(doc: str, name: str) -> bool:
    """Whether a cleaned comment says nothing about the function ``name``."""
    if not doc.strip() or _LICENCE.search(doc):
        return True
    first = next((x for x in (_TAG.sub("", y, count=1) if re.match(r"[@\\](?:brief|details|short|fn|note)\b", y) else y for y in doc.splitlines()) if x.strip()), "")
    if _ELSEWHERE.search(first):
        return True
    lines = [x for x in doc.splitlines() if x.strip()]
    if lines and sum(bool(_CODE_LINE.search(x)) for x in lines) * 2 > len(lines):
        return True
    text = " ".join(_TAG.sub(" ", x) for x in lines)
    han = len(_HAN.findall(text))
    if han:
        return han < 8
    bare = name.lstrip("~")
    own = {bare.lower(), *(w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", bare))}
    said = [w for w in _WORD.findall(re.sub(rf"\b{re.escape(bare)}\b", " ", text)) if w.lower() not in own]
    return len(said) < 4


def _rows(told_only: bool):
    """Batches of entities to functions; ``told_only`` drops what is trivial, and skips code that has nothing to tell."""

    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for eid, kind, name, doc, code in zip(*(b.column(c).to_pylist() for c in ("entity_id", "entity_type", "entity_name", "docstring", "code_text"))):
                code = (code or "").replace("\r\n", "\n").lstrip("\ufeff")
                bare = (name or "").split("::")[-1].strip()
                written = kind == "Function" and bool(doc and doc.strip())
                if "{" not in code or told_only and (trivial(doc, bare) if written else not _DOXYGEN.search(code)):
                    continue
                found = list(documented_functions(code))
                if kind == "Function":
                    found = ([x for x in found if x[0] == bare] or found)[:1]
                for fn, body, above in found:
                    text = doc if written else clean_comment(above)
                    idle = trivial(text, fn)
                    if not (told_only and idle):
                        out.append((eid, fn, text, body, idle))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["entity_id", "function_name", "documentation", "code", "is_trivial"])

    return run


def function_docs(entities: DataFrame, told_only: bool = False) -> DataFrame:
    """(entity_id, function_name, documentation, code, is_trivial) of every function or method with a body.

    The newest row of each entity counts. Functions are documented by their docstring, else by the comment kept above
    them in ``code_text``; methods of classes and structs by the Doxygen comment directly above. Null or empty code has
    no functions; a body that is never closed runs to the end; a null docstring is an empty one; overloads give a row
    each. Rows with a null ``entity_id`` are left out and other columns ignored.
    """
    cols = ["entity_id", "entity_type", "entity_name", "docstring", "code_text"]
    e = newest_rows(entities.select(*cols, "ingested_at"), "entity_id", "ingested_at").select(*cols)
    return e.mapInArrow(_rows(told_only), "entity_id long, function_name string, documentation string, code string, is_trivial boolean")


def described_functions(entities: DataFrame) -> DataFrame:
    """The code-description pairs of ``function_docs`` whose documentation says something."""
    return function_docs(entities, told_only=True).drop("is_trivial")
