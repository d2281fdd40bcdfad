"""Source files that do not parse: recursive descent over statements, precedence climbing over expressions.

One small parser for each of C++, Python and JavaScript. An error is recorded, the parser skips to the next statement
boundary of the same nesting and goes on, so all errors of a file come out and the first is its cause. Statements are
remembered by the kinds of their tokens: one that was accepted before is not parsed again.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPEN, _CLOSE = {"(": ")", "[": "]", "{": "}"}, {")", "]", "}"}


class SyntaxFault(Exception):
    def __init__(self, at: int, what: str):
        super().__init__(what)
        self.at, self.what = at, what


class _Parser:
    """Tokens by kind in ``t`` (names "i", numbers "0", strings "s", else the text itself), ended by ""."""

    BINARY: dict[str, int] = {}
    PREFIX: frozenset[str] = frozenset()
    RIGHT: frozenset[str] = frozenset()
    memo: dict[tuple, bool] = {}

    def __init__(self, kinds: list[str]):
        self.t, self.i, self.errors = [*kinds, "", "", "", ""], 0, []

    def fail(self, what: str = ""):
        raise SyntaxFault(self.i, what or f"unexpected {self.t[self.i] or 'end of file'}")

    def need(self, kind: str):
        if self.t[self.i] != kind:
            self.fail(f"expected {kind} before {self.t[self.i] or 'end of file'}")
        self.i += 1

    def take(self, kind: str) -> bool:
        if self.t[self.i] == kind:
            self.i += 1
            return True
        return False

    def recover(self, e: SyntaxFault, start: int):
        """Panic mode: skip to behind the next ``;`` or block of this nesting, or before the bracket that closes it."""
        self.errors.append((e.at, e.what))
        self.i, depth = max(e.at, start), 0
        while self.t[self.i]:
            x = self.t[self.i]
            if x in _OPEN:
                depth += 1
            elif x in _CLOSE:
                if not depth:
                    if x == "}":
                        break
                else:
                    depth -= 1
                    if not depth and x == "}":
                        self.i += 1
                        break
            elif x == ";" and not depth:
                self.i += 1
                break
            self.i += 1
        if self.i == start:
            self.i += 1

    def expression(self, least: int = 0):
        """Precedence climbing."""
        self.unary()
        t = self.t
        while True:
            op = t[self.i]
            p = self.BINARY.get(op, -1)
            if p < least:
                return
            self.i += 1
            if op == "?":
                self.expression(1)
                self.need(":")
                self.expression(1)
            else:
                self.expression(p if op in self.RIGHT else p + 1)

    def unary(self):
        raise NotImplementedError


# ---------------------------------------------------------------------------------------------------------------- C++

# Words and operators of C++.
_CPP_WORDS = frozenset(
    "alignas alignof asm auto bool break case catch char char8_t char16_t char32_t class const consteval constexpr constinit const_cast continue co_await co_return co_yield decltype default delete do double"
    " dynamic_cast else enum explicit export extern false float for friend goto if inline int long mutable namespace new noexcept nullptr operator private protected public register reinterpret_cast requires"
    " return short signed sizeof static static_assert static_cast struct switch template this thread_local throw true try typedef typeid typename union unsigned using virtual void volatile wchar_t while"
    " final override __attribute__ __declspec __restrict __inline".split()
)
_CPP_BASIC = frozenset("auto bool char char8_t char16_t char32_t double float int long short signed unsigned void wchar_t".split())
_CPP_SPECIFIERS = frozenset("const constexpr consteval constinit explicit extern friend inline mutable register static thread_local typedef virtual volatile typename __restrict __inline".split())
_CPP_CASTS = frozenset("static_cast dynamic_cast reinterpret_cast const_cast".split())
_CPP_NOISE = re.compile(
    r"""//(?:[^\n\\]|\\.|\\\n)*|/\*.*?\*/|(?:\b(?:u8|[uUL])?R"([^()\\\s]{0,16})\(.*?\)\1")|(?:\b(?:u8|[uUL]))?"(?:[^"\\\n]|\\.|\\\r?\n)*"|(?:\b(?:u8|[uUL]))?(?<![0-9A-Fa-f])'(?:[^'\\\n]|\\[^\n])+'|/\*|"|(?<![0-9A-Fa-f])'""",
    re.S,
)
# The same for text without prefixed or raw strings and digit separators: every alternative begins with one of three characters.
_CPP_PLAIN = re.compile(r"""//(?:[^\n\\]|\\.|\\\n)*|/\*.*?\*/|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\[^\n])+'|/\*|["']""", re.S)
_CPP_SPECIAL = re.compile(r"""[8uULR]["']|[0-9A-Fa-f]'|\\\r?\n""")
_CPP_TOKEN = re.compile(r"[^\W\d][\w]*|\.?\d(?:[eEpP][+-]|'\w|[\w.])*|<<=|>>=|\.\.\.|<=>|->\*|::|->|\+\+|--|<<|<=|>=|==|!=|&&|\|\||[-+*/%&|^]=|\.\*|\S")
_CPP_DIRECTIVE = re.compile(r"^[ \t]*#[ \t]*(\w*)((?:[^\n\\]|\\.|\\\n)*)", re.M)
_CPP_KNOWN = frozenset("include define undef if ifdef ifndef elif elifdef elifndef else endif error warning pragma line import include_next ident".split())
_BAD_TEXT, _BAD_DIRECTIVE = "\x01", "\x02"


def _cpp_strip(m: re.Match) -> str:
    x = m.group()
    if x[:2] == "/*":
        return " " + "\n" * x.count("\n") if len(x) > 3 else f" {_BAD_TEXT} "
    if x[:2] == "//":
        return " "
    if len(x) == 1:
        return f" {_BAD_TEXT} "
    return ' "" ' + "\n" * x.count("\n")


_CPP_NEGATED = re.compile(r"!\s*(?:defined\s*(?:\(\s*\w+\s*\)|\w+)|\w+)")


def _cpp_condition(word: str, text: str, defined: dict[str, int]) -> tuple[tuple, bool]:
    """What a condition asks, and the answer that it takes to hold; equal questions have equal answers until a macro they
    name is defined anew."""
    x, holds = re.sub(r"//[^\n]*|/\*.*?\*/|\\\n", " ", text, flags=re.S).strip(), True
    if word.endswith("def"):
        x = f"defined({x})"
    if word.endswith("ndef") or _CPP_NEGATED.fullmatch(x):
        x, holds = x.lstrip("! \t"), not holds
    names = re.findall(r"\w+", x)
    x = " ".join(re.findall(r"\w+|[^\w\s]", re.sub(r"\bdefined\s*\(\s*(\w+)\s*\)", r"defined \1", x)))
    return (x, *[defined.get(n, 0) for n in names]), holds


def _cpp_variants(text: str) -> list[str]:
    """The text with every ``#if`` group as it stands first, with each branch in turn together with those around it, and
    with all groups on their second branches. Groups that ask the same are switched together."""
    if "#" not in text:
        return [text]
    parts: list = []  # text, with the (group, branch) it stands in
    last, stack, groups, bad = 0, [], [], ""  # a group: conditions of its branches, and the branches around it
    defined: dict[str, int] = {}
    for m in _CPP_DIRECTIVE.finditer(text):
        parts.append((tuple(stack), text[last : m.start()]))
        last, word = m.end(), m.group(1)
        if word in ("if", "ifdef", "ifndef"):
            groups.append(([_cpp_condition(word, m.group(2), defined)], tuple(stack)))
            stack.append((len(groups) - 1, 0))
        elif word in ("elif", "elifdef", "elifndef", "else"):
            if stack:
                g, b = stack[-1]
                stack[-1] = (g, b + 1)
                groups[g][0].append(None if word == "else" else _cpp_condition(word, m.group(2), defined))
            else:
                bad += f" {_BAD_DIRECTIVE} "
        elif word == "endif":
            if stack:
                stack.pop()
            else:
                bad += f" {_BAD_DIRECTIVE} "
        elif word not in _CPP_KNOWN and (word or m.group(2).strip()) and not word.isdigit():
            bad += f" {_BAD_DIRECTIVE} "
        elif word in ("define", "undef") and (name := re.match(r"\s*(\w+)", m.group(2))):
            defined[name[1]] = defined.get(name[1], 0) + 1
        parts.append((tuple(stack), "\n" * m.group().count("\n")))
    parts.append((tuple(stack), text[last:]))
    if stack:
        bad += f" {_BAD_DIRECTIVE} "
    for asked, _ in groups:
        asked.append(None)  # nothing holds

    def choose(answers: dict, g: int, b: int) -> bool:
        """Add the answers that lead to a branch; False if others are given already."""
        want = dict([(q, not holds) for q, holds in filter(None, groups[g][0][:b])])
        if groups[g][0][b] is not None:
            q, holds = groups[g][0][b]
            if want.setdefault(q, holds) != holds:
                return False
        if any(answers.get(q, x) != x for q, x in want.items()):
            return False
        answers.update(want)
        return True

    def branches(answers: dict, usual: int) -> list[int]:
        """The branch of every group; questions left open are answered so that it is the ``usual`` one."""
        for g in range(len(groups)):
            choose(answers, g, usual)
            for c in groups[g][0]:
                if c:
                    answers.setdefault(*c)
        return [next(b for b, c in enumerate(asked) if c is None or answers[c[0]] == c[1]) for asked, _ in groups]

    choices = [branches({}, 0)] if groups else [[]]
    for g, (asked, around) in enumerate(groups):
        for b in range(len(asked)):
            answers: dict = {}
            if any(not choose(answers, *x) for x in (*around, (g, b))):
                continue  # no setting leads here
            choices.append(branches(answers, 0))
    if len(groups) > 1:
        choices.append(branches({}, 1))
    # What is left out keeps its lines, so that faults of several variants can be told to be the same.
    return list(dict.fromkeys("".join(s if all(c[g] == b for g, b in where) else "\n" * s.count("\n") for where, s in parts) + (bad and "\n" + bad) for c in choices))


_CPP_KIND: dict[str, str] = {w: w for w in _CPP_WORDS} | {'"': "s", "and": "&&", "or": "||", "not": "!", _BAD_TEXT: _BAD_TEXT, _BAD_DIRECTIVE: _BAD_DIRECTIVE}


def _cpp_kind(x: str) -> str:
    c = x[0]
    if c.isdigit() or (c == "." and len(x) > 1 and x[1].isdigit()):
        return "0"
    if c.isalpha() or c == "_":
        return "M" if len(x) > 1 and x.upper() == x and not x.isdigit() else "i"
    return x


class Cpp(_Parser):
    BINARY = {",": 0, "=": 1, "?": 1, "||": 3, "&&": 4, "|": 5, "^": 6, "&": 7, "==": 8, "!=": 8, "<": 9, ">": 9, "<=": 9, ">=": 9, "<=>": 10, "<<": 11, ">>": 11, "+": 12, "-": 12, "*": 13, "/": 13, "%": 13, ".*": 14, "->*": 14} | {
        x: 1 for x in ("+=", "-=", "*=", "/=", "%=", "&=", "|=", "^=", "<<=", ">>=")
    }
    RIGHT = frozenset(["=", "?", "+=", "-=", "*=", "/=", "%=", "&=", "|=", "^=", "<<=", ">>="])
    PREFIX = frozenset(["!", "~", "+", "-", "*", "&", "++", "--", "&&"])
    memo: dict[tuple, bool] = {}

    @staticmethod
    def tokens(text: str) -> list[str]:
        noise = _CPP_NOISE if _CPP_SPECIAL.search(text) else _CPP_PLAIN
        raw = _CPP_TOKEN.findall(noise.sub(_cpp_strip, text).replace('""', '"'))
        known = _CPP_KIND
        out = []
        for x in raw:
            k = known.get(x)
            if k is None:
                k = _cpp_kind(x)
                if len(known) < 200_000:
                    known[x] = k
            out.append(k)
        if '"' in raw:  # adjacent strings are one
            out = [k for k, before in zip(out, ["", *out]) if not (k == "s" and before == "s")]
        return out

    def expression(self, least: int = 0):
        self.unary()
        t = self.t
        while True:
            op = t[self.i]
            if op == ">" and t[self.i + 1] == ">" and self.BINARY[">>"] >= least:
                self.i += 2
                self.expression(12)
                continue
            p = self.BINARY.get(op, -1)
            if p < least:
                return
            self.i += 1
            if op == "?":
                if t[self.i] != ":":
                    self.expression(0)
                self.need(":")
                self.expression(1)
            elif p == 1 and t[self.i] == "{":
                self.braces()
            else:
                self.expression(p if op in self.RIGHT else p + 1)

    def angles(self, i: int) -> int:
        """Behind the template arguments or parameters that begin at ``i``, or -1."""
        t, depth = self.t, 0
        while True:
            x = t[i]
            if x == "<":
                depth += 1
            elif x == ">":
                depth -= 1
                if not depth:
                    return i + 1
            elif x in ("(", "["):
                i = self.balanced(i) - 1
                if i < 0:
                    return -1
            elif x not in ("i", "M", "0", "s", "::", ",", "*", "&", "&&", "...", "=", "true", "false", "nullptr", "sizeof", "decltype", "typename", "class", "struct", "const", "volatile", "template", "+", "-", "{", "}", "!", "||", "==", "!=") and x not in _CPP_BASIC:
                return -1
            i += 1

    def balanced(self, i: int) -> int:
        """Behind the bracket that closes the one at ``i``, or 0."""
        stack, t = [], self.t
        while t[i]:
            x = t[i]
            if x in _OPEN:
                stack.append(_OPEN[x])
            elif x in _CLOSE:
                if not stack or stack.pop() != x:
                    return 0
                if not stack:
                    return i + 1
            i += 1
        return 0

    def name(self, i: int) -> int:
        """Behind a qualified name, with template arguments, that begins at ``i``, or -1."""
        t = self.t
        if t[i] == "::":
            i += 1
        while True:
            if t[i] == "template":
                i += 1
            if t[i] == "decltype" and t[i + 1] == "(":
                i = self.balanced(i + 1)
                if not i:
                    return -1
            elif t[i] in ("i", "M", "final", "override"):
                i += 1
                if t[i] == "<":
                    j = self.angles(i)
                    if j > 0 and (t[j] in ("(", "::", "{", ")", ";", ",", ">", "&", "*", "&&", "i", "...", "M", "[", "const", "=", "operator", "}", "") or t[j] in _CPP_BASIC):
                        i = j
            else:
                return -1
            if t[i] != "::" or t[i + 1] not in ("i", "M", "template"):
                return i
            i += 1

    def type(self, i: int) -> int:
        """Behind the specifiers and the name of a type that begins at ``i``, or -1."""
        t, seen = self.t, False
        while True:
            x = t[i]
            if x in _CPP_SPECIFIERS:
                i += 1
            elif x in _CPP_BASIC:
                seen, i = True, i + 1
            elif x in ("class", "struct", "union", "enum") and t[i + 1] in ("i", "::", "M"):
                i += 1
            elif not seen and (x in ("i", "M", "::") or x == "decltype"):
                j = self.name(i)
                if j < 0:
                    return -1
                if x == "M" and j == i + 1 and t[j] in ("i", "M") and (t[j + 1] in ("i", "M", "::", "*", "&", "<")):
                    i = j  # a macro before the type
                    continue
                seen, i = True, j
            elif x == "[" and t[i + 1] == "[":
                i = self.balanced(i)
                if not i:
                    return -1
            else:
                return i if seen else -1

    def pointers(self, i: int) -> int:
        t = self.t
        while t[i] in ("*", "&", "&&", "const", "volatile", "...", "__restrict") or (t[i] in ("i",) and t[i + 1] == "::" and t[i + 2] == "*"):
            i += 3 if t[i] == "i" else 1
        return i

    def abstract(self, i: int) -> int:
        """Behind a type with pointers, function and array parts, or -1."""
        i = self.type(i)
        if i < 0:
            return -1
        i = self.pointers(i)
        while self.t[i] in ("(", "["):
            i = self.balanced(i)
            if not i:
                return -1
            while self.t[i] in ("const", "noexcept", "&", "&&"):
                i += 1
        return i

    def unary(self):
        t = self.t
        while True:
            x = t[self.i]
            if x in self.PREFIX or x in ("co_await", "throw", "co_yield"):
                self.i += 1
                if x == "throw" and t[self.i] in (";", ")", ",", ":"):
                    return
                continue
            if x == "sizeof" and t[self.i + 1] == "...":
                self.i += 2
                continue
            if x in ("sizeof", "alignof", "typeid", "noexcept"):
                self.i += 1
                if t[self.i] == "(":
                    j = self.abstract(self.i + 1)
                    if j > 0 and t[j] == ")":
                        self.i = j + 1
                        return self.postfix()
                continue
            if x == "new" or x == "::" and t[self.i + 1] == "new":
                self.i += 1 + (x == "::")
                if t[self.i] == "(":
                    self.parens()
                j = self.type(self.i)
                if j < 0:
                    self.fail()
                self.i = self.pointers(j)
                return self.postfix()
            if x == "delete":
                self.i += 1
                if t[self.i] == "[" and t[self.i + 1] == "]":
                    self.i += 2
                continue
            if x == "(":  # a cast, when a type stands alone in the brackets and an operand follows
                j = self.abstract(self.i + 1)
                if j > 0 and t[j] == ")" and (t[j + 1] in ("i", "M", "0", "s", "(", "this", "true", "false", "nullptr", "!", "~", "new", "sizeof", "{", "::") or t[j + 1] in _CPP_CASTS) and (t[j + 1] != "("or t[j - 1] in _CPP_BASIC or t[j - 1] in ("*", "&")):
                    self.i = j + 1
                    if t[self.i] == "{":
                        self.braces()
                        return self.postfix()
                    continue
            break
        x = t[self.i]
        if x in ("0", "s", "this", "true", "false", "nullptr"):
            self.i += 1
            if x == "s" and t[self.i] in ("i", "M"):  # a user-defined suffix, or a macro between strings
                self.i += 1
                while t[self.i] in ("s", "M"):
                    self.i += 1
        elif x in ("i", "M", "::", "decltype", "final", "override"):
            j = self.name(self.i)
            if j < 0:
                self.fail()
            self.i = j
            if x == "M":
                while t[self.i] in ("s", "M"):  # macros that stand for strings
                    self.i += 1
            if t[self.i] == "::":
                self.i += 1
                self.operator_name()
        elif x in ("operator", "~"):
            self.operator_name()
        elif x == "(":
            self.parens()
        elif x == "[":
            self.capture()
        elif x == "{":
            self.braces()
        elif x in _CPP_CASTS:
            self.i += 1
            j = self.angles(self.i)
            if j < 0:
                self.fail("expected a type")
            self.i = j
            if t[self.i] != "(":
                self.fail()
            self.parens()
        elif x in _CPP_BASIC or x == "typename":
            j = self.type(self.i)
            if j < 0 or t[j] not in ("(", "{"):
                self.fail()
            self.i = j
        elif x == "requires":
            self.i += 1
            if t[self.i] == "(":
                self.parameters()
            self.i = self.balanced(self.i) or self.fail()
        else:
            self.fail()
        self.postfix()

    def postfix(self):
        t = self.t
        while True:
            x = t[self.i]
            if x == "(":
                self.parens()
            elif x == "[":
                self.i += 1
                if t[self.i] != "]":
                    self.expression()
                self.need("]")
            elif x in (".", "->"):
                self.i += 1
                self.take("template")
                if t[self.i] in ("~", "operator"):
                    self.operator_name()
                else:
                    j = self.name(self.i)
                    if j < 0:
                        self.fail()
                    self.i = j
            elif x in ("++", "--"):
                self.i += 1
            elif x == "..." and t[self.i + 1] in (")", ",", "}", ">"):
                self.i += 1
            elif x == "{" and (t[self.i - 1] in ("i", ">", ")", "M") or t[self.i - 1] in _CPP_BASIC) and self.initialiser_follows():
                self.braces()
            else:
                return

    def initialiser_follows(self) -> bool:
        """Whether the brace here initialises rather than opens a block: no statement is in it."""
        j = self.balanced(self.i)
        return bool(j) and self.t[self.i - 1] != ")" and ";" not in self.t[self.i : j] and not getattr(self, "in_head", False)

    def parens(self):
        """Arguments, a bracketed expression, or types as a macro's or a template's arguments."""
        self.need("(")
        held, self.in_head = getattr(self, "in_head", False), False
        t = self.t
        if t[self.i] != ")":
            while True:
                if t[self.i] == "{":
                    self.braces()
                elif t[self.i] in ("*", "&", "+", "&&", "||", "<<", ",") and t[self.i + 1] == "...":  # fold expressions
                    self.i += 2
                elif t[self.i] == "..." and t[self.i + 1] in self.BINARY:
                    self.i += 2
                    self.expression(1)
                else:
                    start = self.i
                    try:
                        self.expression(1)
                        if t[self.i] in self.BINARY and t[self.i + 1] == "...":
                            self.i += 2
                            if t[self.i] in self.BINARY:
                                self.i += 1
                                self.expression(1)
                    except SyntaxFault:
                        j = self.abstract(start)
                        if j < 0 or t[j] not in (",", ")"):
                            raise
                        self.i = j
                if not self.take(","):
                    break
                if t[self.i] == ")":
                    self.fail()
        self.need(")")
        self.in_head = held

    def braces(self):
        self.need("{")
        held, self.in_head = getattr(self, "in_head", False), False
        while self.t[self.i] != "}":
            if self.t[self.i] == "." and self.t[self.i + 1] in ("i", "M"):
                self.i += 2
                self.take("=")
            if self.t[self.i] == "{":
                self.braces()
            else:
                self.expression(1)
            if not self.take(","):
                break
        self.need("}")
        self.in_head = held

    def capture(self):
        """A lambda."""
        self.need("[")
        t = self.t
        while t[self.i] != "]":
            default = t[self.i] == "=" or t[self.i] == "&" and t[self.i + 1] in (",", "]")
            if not default:
                self.take("&") or self.take("*")
                self.take("...")
            if default:
                self.i += 1
            elif t[self.i] in ("i", "M", "this"):
                self.i += 1
                self.take("...")
                if self.take("="):
                    self.expression(1)
                elif t[self.i] in ("(", "{"):
                    self.i = self.balanced(self.i) or self.fail()
            else:
                self.fail()
            if not self.take(","):
                break
        self.need("]")
        if t[self.i] == "<":
            j = self.angles(self.i)
            self.i = j if j > 0 else self.fail()
        if t[self.i] == "(":
            self.parameters()
        while t[self.i] in ("mutable", "constexpr", "static", "consteval"):
            self.i += 1
        self.noexcept()
        if self.take("->"):
            j = self.abstract(self.i)
            self.i = j if j > 0 else self.fail()
        if t[self.i] != "{":
            self.fail("expected { of a lambda")
        held, self.in_head = getattr(self, "in_head", False), False
        self.block()
        self.in_head = held

    def noexcept(self):
        if self.take("noexcept") and self.t[self.i] == "(":
            self.parens()

    def operator_name(self):
        t = self.t
        if self.take("~"):
            if t[self.i] not in ("i", "M"):
                self.fail()
            self.i += 1
            return
        self.need("operator")
        if t[self.i] == "(" and t[self.i + 1] == ")" or t[self.i] == "[" and t[self.i + 1] == "]":
            self.i += 2
        elif t[self.i] in ("new", "delete"):
            self.i += 1
            if t[self.i] == "[":
                self.i += 2
        elif t[self.i] == "s":
            self.i += 1
            if t[self.i] in ("i", "M"):
                self.i += 1
        elif t[self.i] in self.BINARY or t[self.i] in ("++", "--", "!", "~", "->", "->*", "co_await"):
            self.i += 1 + (t[self.i] == ">" and t[self.i + 1] == ">")
        else:
            j = self.abstract_no_call(self.i)
            self.i = j if j > 0 else self.fail()

    def abstract_no_call(self, i: int) -> int:
        i = self.type(i)
        return self.pointers(i) if i > 0 else -1

    def attributes(self):
        t = self.t
        while True:
            if t[self.i] == "[" and t[self.i + 1] == "[":
                self.i = self.balanced(self.i) or self.fail()
            elif t[self.i] in ("alignas", "__attribute__", "__declspec") and t[self.i + 1] == "(":
                self.i = self.balanced(self.i + 1) or self.fail()
            else:
                return

    # declarations

    def parameters(self):
        self.need("(")
        t = self.t
        while t[self.i] != ")":
            if self.take("..."):
                break
            self.attributes()
            j = self.type(self.i)
            if j < 0:
                self.fail("expected a parameter")
            self.i = self.pointers(j)
            if t[self.i] == "(":
                self.i = self.balanced(self.i) or self.fail()
                if t[self.i] == "(":
                    self.i = self.balanced(self.i) or self.fail()
            elif t[self.i] in ("i", "M"):
                self.i += 1
            while t[self.i] == "[":
                self.i += 1
                if t[self.i] != "]":
                    self.expression()
                self.need("]")
            if self.take("="):
                if t[self.i] == "{":
                    self.braces()
                else:
                    self.expression(1)
            if not self.take(","):
                break
            if t[self.i] == ")":
                self.fail()
        self.need(")")

    def program(self):
        self.members("", False)
        return self.errors

    def members(self, close: str, in_class: bool):
        t = self.t
        while t[self.i] and t[self.i] != close:
            start = self.i
            try:
                if t[self.i] == "}":
                    self.fail("} closes nothing")
                self.declaration(in_class)
            except SyntaxFault as e:
                self.recover(e, start)
                if t[self.i] == "}" and not close:
                    self.i += 1
            except RecursionError:
                self.recover(SyntaxFault(start, "nested too deeply"), start)

    def declaration(self, in_class: bool):
        t = self.t
        self.attributes()
        x = t[self.i]
        if x == ";":
            self.i += 1
            return
        if in_class and x in ("public", "private", "protected"):
            self.i += 1
            self.need(":")
            return
        if in_class and x == "i" and t[self.i + 1] == ":" and t[self.i - 1] in (";", "}", "{"):
            self.fail()
        if x == "M" and (t[self.i + 1] in ("M", "}", "class", "struct", "template", "namespace", "using", "static", "enum", "") or t[self.i + 1] == "(" and self.macro_call()):
            self.i += 1
            if t[self.i] == "(":
                self.i = self.balanced(self.i) or self.fail()
            self.take(";")
            return
        if x == "namespace" or x == "inline" and t[self.i + 1] == "namespace":
            self.i += 1 + (x == "inline")
            self.attributes()
            j = self.name(self.i) if t[self.i] != "{" else self.i
            self.i = j if j > 0 else self.fail()
            if self.take("="):
                j = self.name(self.i)
                self.i = j if j > 0 else self.fail()
                self.need(";")
                return
            self.need("{")
            self.members("}", False)
            self.need("}")
            return
        if x == "extern" and t[self.i + 1] == "s":
            self.i += 2
            if self.take("{"):
                self.members("}", False)
                self.need("}")
            else:
                self.declaration(False)
            return
        if x == "template" or x == "export" and t[self.i + 1] == "template":
            self.i += 1 + (x == "export")
            if t[self.i] == "<":
                j = self.angles(self.i)
                self.i = j if j > 0 else self.fail("template parameters")
            if self.take("requires"):
                self.expression(3)
            self.declaration(in_class)
            return
        if x == "using":
            self.i += 1
            self.take("namespace") or self.take("enum") or self.take("typename")
            j = self.name(self.i)
            if j < 0:
                self.fail()
            self.i = j
            if t[self.i] == "::" and t[self.i + 1] in ("operator", "~"):
                self.i += 1
                self.operator_name()
            self.attributes()
            if self.take("="):
                j = self.abstract(self.i)
                self.i = j if j > 0 else self.fail("expected a type")
            self.need(";")
            return
        if x == "static_assert":
            self.i += 1
            self.parens()
            self.need(";")
            return
        if x == "asm":
            self.i = self.balanced(self.i + 1) or self.fail()
            self.need(";")
            return
        k = self.i
        while t[k] in _CPP_SPECIFIERS:
            k += 1
        if t[k] in ("class", "struct", "union", "enum"):
            held = self.i
            self.i = k
            if self.body_of_type():
                return self.declarators(in_class, True)
            self.i = held
        self.simple(in_class)

    def macro_call(self) -> bool:
        j = self.balanced(self.i + 1)
        return bool(j) and self.t[j] in ("M", "}", "i", "class", "struct", "template", "namespace", "using", "static", "public", "private", "protected", "~", "const", "void", "virtual", "[", ";", "", "auto", "int", "bool", "explicit", "inline", "enum", "typedef", "friend")

    def body_of_type(self) -> bool:
        """A class, struct, union or enum with members; False when none is defined here."""
        t = self.t
        kind = t[self.i]
        self.i += 1
        if kind == "enum":
            self.take("class") or self.take("struct")
        self.attributes()
        while t[self.i] == "M" and t[self.i + 1] in ("i", "M", "("):
            self.i += 1
            if t[self.i] == "(":
                self.i = self.balanced(self.i) or self.fail()
            self.attributes()
        if t[self.i] not in ("{", ":"):
            j = self.name(self.i)
            if j < 0:
                self.fail()
            self.i = j
            if t[self.i] == "i" and t[self.i - 1] != "i":
                return False
        self.take("final")
        if kind == "enum":
            if self.take(":"):
                j = self.type(self.i)
                self.i = j if j > 0 else self.fail()
            if t[self.i] != "{":
                return False
            self.i += 1
            while t[self.i] != "}":
                if t[self.i] not in ("i", "M"):
                    self.fail()
                self.i += 1
                self.attributes()
                if self.take("="):
                    self.expression(1)
                if not self.take(","):
                    break
            self.need("}")
            return True
        if self.take(":"):
            while True:
                while t[self.i] in ("public", "private", "protected", "virtual"):
                    self.i += 1
                j = self.name(self.i)
                self.i = j if j > 0 else self.fail("expected a base class")
                self.take("...")
                if not self.take(","):
                    break
            if t[self.i] != "{":
                self.fail()
        if t[self.i] != "{":
            return False
        self.i += 1
        self.members("}", True)
        self.need("}")
        return True

    def simple(self, in_class: bool):
        """Specifiers and declarators: variables, functions, constructors, conversions."""
        t = self.t
        while t[self.i] in _CPP_SPECIFIERS and t[self.i] != "typename":
            self.i += 1
            if t[self.i - 1] == "explicit" and t[self.i] == "(":
                self.parens()
        if t[self.i] == "M" and t[self.i + 1] in ("i", "M") or t[self.i] == "M" and t[self.i + 1] in _CPP_BASIC | _CPP_SPECIFIERS:
            self.i += 1
        if t[self.i] in ("operator", "~"):
            return self.declarators(in_class, False)
        j = self.type(self.i)
        if j < 0:
            self.fail()
        if t[j] == "(" and t[j - 1] not in _CPP_BASIC or t[j] == "::" and t[j + 1] in ("~", "operator"):
            self.i = j  # a constructor or destructor, or an operator out of its class
            if self.take("::"):
                self.operator_name()
            return self.function(in_class)
        self.i = j
        self.declarators(in_class, t[j] == ";" and not in_class)

    def declarators(self, in_class: bool, may_be_none: bool):
        t = self.t
        if may_be_none and self.take(";"):
            return
        while True:
            self.i = self.pointers(self.i)
            self.attributes()
            if t[self.i] in ("operator", "~"):
                self.operator_name()
            elif t[self.i] == "(":
                j = self.balanced(self.i)
                if not j:
                    self.fail()
                self.i = j
            elif t[self.i] == "[" and t[self.i - 1] in ("auto", "&", "&&"):
                self.i = self.balanced(self.i) or self.fail()
            elif t[self.i] == ":" and in_class:
                pass
            else:
                j = self.name(self.i)
                if j < 0:
                    self.fail()
                self.i = j
                if t[self.i] == "::":
                    self.i += 1
                    self.operator_name()
            if t[self.i] == "(":
                if self.function(in_class):
                    return
            else:
                while t[self.i] == "[":
                    self.i += 1
                    if t[self.i] != "]":
                        self.expression()
                    self.need("]")
                self.attributes()
                if in_class and self.take(":"):
                    self.expression(1)
                if self.take("="):
                    if t[self.i] == "{":
                        self.braces()
                    else:
                        self.expression(1)
                elif t[self.i] == "{":
                    self.braces()
            if not self.take(","):
                break
        self.need(";")

    def function(self, in_class: bool) -> bool:
        """Behind a declarator's name: parameters and what may follow. True when a body or a semicolon ended it."""
        t, start = self.t, self.i
        try:
            self.parameters()
        except SyntaxFault:
            at = self.i
            self.i = start
            try:
                self.parens()
            except SyntaxFault:
                self.i = max(at, self.i)
                raise
        while True:
            x = t[self.i]
            if x in ("const", "volatile", "override", "final", "&", "&&", "try"):
                self.i += 1
            elif x == "noexcept":
                self.noexcept()
            elif x == "throw" and t[self.i + 1] == "(":
                self.i = self.balanced(self.i + 1) or self.fail()
            elif x == "->":
                self.i += 1
                j = self.abstract(self.i)
                self.i = j if j > 0 else self.fail()
            elif x == "requires":
                self.i += 1
                self.expression(3)
            elif x == "[" and t[self.i + 1] == "[" or x in ("__attribute__", "alignas"):
                self.attributes()
            elif x == "M" and t[self.i + 1] in ("{", ";", "M", "(", "const", "override"):
                self.i += 1
                if t[self.i] == "(":
                    self.i = self.balanced(self.i) or self.fail()
            else:
                break
        x = t[self.i]
        if x == "=":
            self.i += 1
            if t[self.i] in ("default", "delete", "0"):
                self.i += 1
            else:
                self.expression(1)
        elif x == ":":
            self.i += 1
            while True:
                j = self.name(self.i)
                if j < 0:
                    self.fail("expected a member initialiser")
                self.i = j
                if t[self.i] == "(":
                    self.parens()
                elif t[self.i] == "{":
                    self.braces()
                else:
                    self.fail()
                self.take("...")
                if not self.take(","):
                    break
            if t[self.i] != "{":
                self.fail()
            x = "{"
        if x == "{":
            self.block()
            while t[self.i] == "catch":
                self.handler()
            return True
        if t[self.i] == ",":
            return False
        self.need(";")
        return True

    def handler(self):
        self.need("catch")
        if self.t[self.i] == "(" and self.t[self.i + 1] == "..." and self.t[self.i + 2] == ")":
            self.i += 3
        else:
            self.parameters()
        self.block()

    # statements

    def block(self):
        self.need("{")
        t = self.t
        while t[self.i] and t[self.i] != "}":
            start = self.i
            try:
                self.statement()
            except SyntaxFault as e:
                self.recover(e, start)
        self.need("}")

    def statement(self):
        t, i = self.t, self.i
        x = t[i]
        if x == "{":
            return self.block()
        if x == ";":
            self.i += 1
            return
        if x in ("if", "while", "for", "switch"):
            try:
                j = t.index("{", i)
            except ValueError:
                j = 0
            key = tuple(t[i : j + 1]) if j and j - i < 40 else None
            if key and key in self.memo:
                self.i = j
            else:
                self.head()
                if key and self.i == j and len(self.memo) < 400_000:
                    self.memo[key] = True
            self.statement()
            if x == "if" and self.take("else"):
                self.statement()
            return
        if x == "else":
            self.fail("else without if")
        if x == "do":
            self.i += 1
            self.statement()
            self.need("while")
            self.parens()
            self.need(";")
            return
        if x == "case":
            self.i += 1
            self.expression(1)
            if self.take("..."):
                self.expression(1)
            self.need(":")
            return
        if x == "default" and t[i + 1] == ":":
            self.i += 2
            return
        if x == "i" and t[i + 1] == ":" and t[i + 2] != ":":
            self.i += 2
            return
        if x == "try":
            self.i += 1
            self.block()
            if t[self.i] != "catch":
                self.fail("try without catch")
            while t[self.i] == "catch":
                self.handler()
            return
        try:
            j = t.index(";", i)
        except ValueError:
            j = 0
        key = tuple(t[i : j + 1]) if j and j - i < 60 else None
        if key and key in self.memo:
            self.i = j + 1
            return
        known = len(self.errors)
        self.plain()
        if key and self.i == j + 1 and len(self.errors) == known and len(self.memo) < 400_000:
            self.memo[key] = True

    def head(self):
        t = self.t
        kind = t[self.i]
        self.i += 1
        if kind == "if":
            self.take("constexpr") or (self.take("!") and self.need("consteval")) or self.take("consteval")
        if kind == "if" and t[self.i] == "{":
            return
        self.need("(")
        if kind == "for":
            if t[self.i] != ";":
                if not self.variable():
                    self.expression()
                if self.take(":"):
                    self.braces() if t[self.i] == "{" else self.expression()
                    self.need(")")
                    return
            self.need(";")
            if t[self.i] == ";":
                self.i += 1
            else:
                self.expression()
                if self.take(":"):
                    self.expression()
                    self.need(")")
                    return
                self.need(";")
            if t[self.i] != ")":
                self.expression()
        else:
            if not self.variable():
                self.expression()
            if self.take(";") and not self.variable():
                self.expression()
        self.need(")")

    def variable(self) -> bool:
        """Declarators without their end, if a declaration begins here."""
        t, start = self.t, self.i
        self.attributes()
        j = self.type(self.i)
        if j > 0:
            bound = t[j - 1] == "auto" or t[j] in ("&", "&&") and t[j + 1] == "["
            j = self.pointers(j)
            if t[j] in ("i", "M") and t[j + 1] in ("=", ";", "{", "(", "[", ",", ")", ":") or bound and t[j] == "[":
                self.i = j
                while True:
                    self.i = self.pointers(self.i)
                    if t[self.i] == "[":
                        self.i = self.balanced(self.i) or self.fail()
                    elif t[self.i] in ("i", "M"):
                        self.i += 1
                    else:
                        self.fail()
                    while t[self.i] == "[":
                        self.i += 1
                        if t[self.i] != "]":
                            self.expression()
                        self.need("]")
                    if self.take("="):
                        self.braces() if t[self.i] == "{" else self.expression(1)
                    elif t[self.i] == "(":
                        begin = self.i
                        try:
                            self.parens()
                        except SyntaxFault:
                            self.i = begin
                            self.parameters()
                    elif t[self.i] == "{":
                        self.braces()
                    if not self.take(","):
                        return True
        self.i = start
        return False

    def plain(self):
        """A declaration, jump or expression with its semicolon."""
        t = self.t
        x = t[self.i]
        if x in ("return", "co_return", "co_yield"):
            self.i += 1
            if t[self.i] == "{":
                self.braces()
            elif t[self.i] != ";":
                self.expression()
            self.need(";")
        elif x in ("break", "continue"):
            self.i += 1
            self.need(";")
        elif x == "goto":
            self.i += 2
            self.need(";")
        elif x in ("using", "typedef", "static_assert", "class", "struct", "union", "enum", "template", "namespace", "asm", "extern", "friend"):
            self.declaration(False)
        elif x == "[" and t[self.i + 1] == "[":
            self.attributes()
            self.statement()
        else:
            j = self.type(self.i)
            if j > 0 and (t[self.i] in _CPP_BASIC or t[self.i] in _CPP_SPECIFIERS or self.declares(j)):
                if self.variable():
                    self.need(";")
                    return
                self.declaration(False)
                return
            held, self.in_head = getattr(self, "in_head", False), False
            self.expression()
            self.in_head = held
            if t[self.i] != ";" and x == "M" and t[self.i - 1] in (")", "M"):
                return  # a macro that brings its own end
            self.need(";")

    def declares(self, j: int) -> bool:
        k = self.pointers(j)
        return self.t[k] in ("i", "M") and self.t[k + 1] in ("=", ";", "{", "(", "[", ",")


def _cpp_places(text: str) -> list[tuple[int, int]]:
    """The line of every token and its number within the line."""
    noise = _CPP_NOISE if _CPP_SPECIAL.search(text) else _CPP_PLAIN
    out: list[tuple[int, int]] = []
    before = ""
    for n, line in enumerate(noise.sub(_cpp_strip, text).replace('""', '"').split("\n")):
        for k, x in enumerate(_CPP_TOKEN.findall(line)):
            if not (x == before == '"'):
                out.append((n, k))
            before = x
    return out


def check_cpp(text: str) -> list[str]:
    """The faults of all variants, each place once."""
    faults: dict[tuple, str] = {}
    variants = _cpp_variants(text)
    for v in variants:
        p = Cpp(Cpp.tokens(v))
        try:
            found = p.program()
        except RecursionError:
            found = [(0, "nested too deeply")]
        if p.errors or found:
            places = _cpp_places(v) if len(variants) > 1 else None
            for n, (at, what) in enumerate(p.errors or found):
                faults.setdefault((n, at) if places is None else places[at] if at < len(places) else (-1, 0), what)
    return list(faults.values())


# ------------------------------------------------------------------------------------------------------------- Python

# Words and tokens of Python 3.
_PY_WORDS = frozenset("False None True and as assert async await break class continue def del elif else except finally for from global if import in is lambda nonlocal not or pass raise return try while with yield".split())
_PY_TOKEN = re.compile(
    r"""(?P<str>(?:\b[rRbBuUfFtT]{1,2})?(?:\"\"\"(?:[^\\]|\\.)*?\"\"\"|'''(?:[^\\]|\\.)*?'''|(?!\"\"\")"(?:[^"\\\n]|\\.)*"|(?!''')'(?:[^'\\\n]|\\.)*'))|(?P<note>\#[^\n]*)|(?P<join>\\\r?\n)|(?P<nl>\r?\n)|(?P<blank>[ \t\f]+)"""
    r"""|(?P<num>0[xX](?:_?[0-9a-fA-F])+|0[bB](?:_?[01])+|0[oO](?:_?[0-7])+|(?:\d(?:_?\d)*\.?(?:\d(?:_?\d)*)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?[jJ]?(?!\w))|(?P<name>[^\W\d]\w*)"""
    r"""|(?P<op>\*\*=|//=|>>=|<<=|\.\.\.|->|:=|!=|==|<=|>=|\*\*|//|<<|>>|[-+*/%&|^@]=|[-+*/%&|^~<>()\[\]{},:;.=@])|(?P<bad>.)""",
    re.S,
)
_NEWLINE, _INDENT, _DEDENT = "\n", "\t", "\r"


def _py_tokens(text: str) -> list[str]:
    out: list[str] = []
    depth, levels, fresh, width = 0, [0], True, 0
    for m in _PY_TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "blank":
            if fresh:
                width = len(m.group().expandtabs(8))
            continue
        if kind in ("note", "join"):
            continue
        if kind == "nl":
            if not depth:
                if not fresh:
                    out.append(_NEWLINE)
                fresh, width = True, 0
            continue
        if fresh:
            fresh = False
            if width > levels[-1]:
                levels.append(width)
                out.append(_INDENT)
            while width < levels[-1]:
                levels.pop()
                out.append(_DEDENT)
                if width > levels[-1]:
                    out.append(_BAD_TEXT)
        x = m.group()
        if kind == "str":
            if out and out[-1] == "s":
                continue
            out.append("s")
        elif kind == "num":
            out.append(_BAD_TEXT if len(x) > 1 and x[0] == "0" and x.isdigit() and x.strip("0") else "0")
        elif kind == "name":
            out.append(x if x in _PY_WORDS else x if x in ("match", "case", "type") else "i")
        elif kind == "bad":
            out.append(_BAD_TEXT)
        else:
            depth += (x in _OPEN) - (x in _CLOSE)
            depth = max(depth, 0)
            out.append(x)
    if not fresh:
        out.append(_NEWLINE)
    out += [_DEDENT] * (len(levels) - 1)
    if depth:
        out.append(_BAD_TEXT)
    return out


class Python(_Parser):
    BINARY = {"or": 1, "and": 2, "in": 4, "not": 4, "is": 4, "<": 4, ">": 4, "==": 4, "!=": 4, "<=": 4, ">=": 4, "|": 5, "^": 6, "&": 7, "<<": 8, ">>": 8, "+": 9, "-": 9, "*": 10, "/": 10, "//": 10, "%": 10, "@": 10, "**": 12}
    SOFT = ("i", "match", "case", "type")
    AUGMENTED = frozenset("+= -= *= /= //= %= @= &= |= ^= >>= <<= **=".split())

    def recover(self, e: SyntaxFault, start: int):
        """Panic mode: skip to the next line of this indentation."""
        self.errors.append((e.at, e.what))
        self.i, depth = max(e.at, start), 0
        while self.t[self.i]:
            x = self.t[self.i]
            if x == _INDENT:
                depth += 1
            elif x == _DEDENT:
                if not depth:
                    return
                depth -= 1
                if not depth:
                    self.i += 1
                    return
            elif x == _NEWLINE and not depth and self.t[self.i + 1] != _INDENT:
                self.i += 1
                return
            self.i += 1

    def program(self):
        t = self.t
        while t[self.i]:
            start = self.i
            try:
                self.statement()
            except (SyntaxFault, RecursionError) as e:
                self.recover(e if isinstance(e, SyntaxFault) else SyntaxFault(start, "nested too deeply"), start)
                if self.i == start:
                    self.i += 1
        return self.errors

    def suite(self):
        self.need(":")
        if self.take(_NEWLINE):
            self.need(_INDENT)
            while self.t[self.i] not in (_DEDENT, ""):
                start = self.i
                try:
                    self.statement()
                except SyntaxFault as e:
                    self.recover(e, start)
                    if self.i == start:
                        self.i += 1
            self.need(_DEDENT)
        else:
            self.simple_line()

    def statement(self):
        t = self.t
        x = t[self.i]
        if x == "async" and t[self.i + 1] in ("def", "for", "with"):
            self.i += 1
            x = t[self.i]
        if x == "@":
            while self.take("@"):
                self.test()
                self.need(_NEWLINE)
            if t[self.i] not in ("def", "class", "async"):
                self.fail()
            self.statement()
        elif x == "def":
            self.i += 1
            self.identifier()
            self.type_parameters()
            self.need("(")
            self.parameters(")")
            self.need(")")
            if self.take("->"):
                self.tests()
            self.suite()
        elif x == "class":
            self.i += 1
            self.identifier()
            self.type_parameters()
            if self.take("("):
                self.arguments()
            self.suite()
        elif x in ("if", "while"):
            self.i += 1
            self.named()
            self.suite()
            while x == "if" and self.take("elif"):
                self.named()
                self.suite()
            if self.take("else"):
                self.suite()
        elif x == "for":
            self.i += 1
            self.targets()
            self.need("in")
            self.stars()
            self.suite()
            if self.take("else"):
                self.suite()
        elif x == "try":
            self.i += 1
            self.suite()
            n = 0
            while self.take("except"):
                n += 1
                self.take("*")
                if t[self.i] != ":":
                    self.tests()
                    if self.take("as"):
                        self.identifier()
                self.suite()
            if n and self.take("else"):
                self.suite()
            if self.take("finally"):
                self.suite()
            elif not n:
                self.fail("try without except")
        elif x == "with":
            self.i += 1
            self.with_items()
            self.suite()
        elif x == "match" and self.is_match():
            self.i += 1
            self.stars()
            self.need(":")
            self.need(_NEWLINE)
            self.need(_INDENT)
            while t[self.i] == "case":
                self.i += 1
                self.pattern()
                if self.take("if"):
                    self.named()
                self.suite()
            self.need(_DEDENT)
        else:
            self.simple_line()

    def is_match(self) -> bool:
        j, depth, t = self.i + 1, 0, self.t
        if t[j] in ("=", ".", ",", ")", ":", _NEWLINE) or t[j] in self.AUGMENTED:
            return False
        while t[j] not in (_NEWLINE, ""):
            depth += (t[j] in _OPEN) - (t[j] in _CLOSE)
            j += 1
        return t[j - 1] == ":" and t[j + 1] == _INDENT and t[j + 2] == "case"

    def pattern(self):
        while True:
            self.take("*")
            self.expression(5)
            while self.take("as"):
                self.identifier()
            if not self.take(",") or self.t[self.i] in (":", "if"):
                return

    def with_items(self):
        if self.t[self.i] == "(":
            start, known = self.i, len(self.errors)
            try:
                self.i += 1
                while self.t[self.i] != ")":
                    self.test()
                    if self.take("as"):
                        self.target()
                    if not self.take(","):
                        break
                self.need(")")
                if self.t[self.i] == ":":
                    return
            except SyntaxFault:
                pass
            self.i = start
            del self.errors[known:]
        while True:
            self.test()
            if self.take("as"):
                self.target()
            if not self.take(","):
                return

    def simple_line(self):
        while True:
            self.small()
            if not self.take(";") or self.t[self.i] == _NEWLINE:
                break
        self.need(_NEWLINE)

    def small(self):
        t = self.t
        x = t[self.i]
        if x in ("pass", "break", "continue"):
            self.i += 1
        elif x == "return":
            self.i += 1
            if t[self.i] not in (_NEWLINE, ";"):
                self.stars()
        elif x == "raise":
            self.i += 1
            if t[self.i] not in (_NEWLINE, ";"):
                self.test()
                if self.take("from"):
                    self.test()
        elif x in ("global", "nonlocal"):
            self.i += 1
            self.identifier()
            while self.take(","):
                self.identifier()
        elif x == "del":
            self.i += 1
            self.targets()
        elif x == "assert":
            self.i += 1
            self.test()
            if self.take(","):
                self.test()
        elif x == "import":
            self.i += 1
            while True:
                self.dotted()
                if self.take("as"):
                    self.identifier()
                if not self.take(","):
                    break
        elif x == "from":
            self.i += 1
            dots = 0
            while t[self.i] in (".", "..."):
                self.i += 1
                dots += 1
            if t[self.i] != "import" or not dots:
                self.dotted()
            self.need("import")
            if self.take("*"):
                return
            held = self.take("(")
            while True:
                self.identifier()
                if self.take("as"):
                    self.identifier()
                if not self.take(",") or held and t[self.i] == ")":
                    break
            if held:
                self.need(")")
        elif x == "type" and t[self.i + 1] in self.SOFT and t[self.i + 2] in ("=", "["):
            self.i += 1
            self.identifier()
            self.type_parameters()
            self.need("=")
            self.test()
        else:
            start = self.i
            self.stars()
            if t[self.i] in self.AUGMENTED:
                self.assignable(start)
                self.i += 1
                self.stars()
            elif t[self.i] == ":":
                self.assignable(start)
                self.i += 1
                self.test()
                if self.take("="):
                    self.stars()
            else:
                while t[self.i] == "=":
                    self.assignable(start)
                    self.i += 1
                    start = self.i
                    self.stars()

    def assignable(self, start: int):
        """The left side just parsed ends in a name, attribute, subscript or bracketed targets."""
        t = self.t
        last = t[self.i - 1]
        if last in ("0", "s", "True", "False", "None", "...") or last == "}" or t[start] in ("lambda", "not", "yield", "await", "-", "+", "~"):
            self.fail("cannot assign here")
        depth = 0
        for j in range(start, self.i):
            x = t[j]
            if not depth and j > start and (x in self.BINARY and x != "*" or x in ("if", "else", ":=")):
                self.fail("cannot assign here")
            if x == "(" and not depth and j > start and (t[j - 1] in self.SOFT or t[j - 1] in (")", "]")):
                k, d = j, 0
                while k < self.i:
                    d += (t[k] in _OPEN) - (t[k] in _CLOSE)
                    if not d:
                        break
                    k += 1
                if k == self.i - 1 or t[k + 1] == ",":
                    self.fail("cannot assign to a call")
            depth += (x in _OPEN) - (x in _CLOSE)

    def identifier(self):
        if self.t[self.i] not in self.SOFT:
            self.fail("expected a name")
        self.i += 1

    def dotted(self):
        self.identifier()
        while self.take("."):
            self.identifier()

    def type_parameters(self):
        if self.take("["):
            while self.t[self.i] != "]":
                if self.t[self.i] in ("*", "**"):
                    self.i += 1
                self.identifier()
                if self.take(":"):
                    self.test()
                if self.take("="):
                    self.test()
                if not self.take(","):
                    break
            self.need("]")

    def parameters(self, close: str):
        defaults = False
        starred = False
        while self.t[self.i] != close:
            if self.take("/"):
                pass
            elif self.t[self.i] in ("*", "**"):
                starred = True
                self.i += 1
                if self.t[self.i] != ",":
                    self.identifier()
                    if close == ")" and self.take(":"):
                        self.take("*")
                        self.test()
            else:
                self.identifier()
                if close == ")" and self.take(":"):
                    self.test()
                if self.take("="):
                    defaults = True
                    self.test()
                elif defaults and not starred:
                    self.fail("a parameter without default follows one with")
            if not self.take(","):
                break

    def targets(self):
        while True:
            self.target()
            if not self.take(",") or self.t[self.i] in ("in", _NEWLINE, ";", "="):
                return

    def target(self):
        self.take("*")
        self.expression(5)

    def stars(self):
        """Expressions with commas, stars and yields."""
        t = self.t
        if t[self.i] == "yield":
            return self.yields()
        while True:
            if self.take("*"):
                self.expression(5)
            else:
                self.named()
            if not self.take(",") or t[self.i] in (_NEWLINE, "=", ")", "]", "}", ":", ";", ""):
                return

    def yields(self):
        self.need("yield")
        if self.take("from"):
            self.test()
        elif self.t[self.i] not in (_NEWLINE, ")", "]", "}", ";", "="):
            self.stars()

    def tests(self):
        self.test()
        while self.take(","):
            if self.t[self.i] in (":", _NEWLINE, ")"):
                return
            self.test()

    def named(self):
        if self.t[self.i] in self.SOFT and self.t[self.i + 1] == ":=":
            self.i += 2
        self.test()

    def test(self):
        if self.take("lambda"):
            self.parameters(":")
            self.need(":")
            return self.test()
        self.expression(1)
        if self.take("if"):
            self.expression(1)
            self.need("else")
            self.test()

    def expression(self, least: int = 1):
        self.unary()
        t = self.t
        while True:
            op = t[self.i]
            p = self.BINARY.get(op, -1)
            if p < least:
                return
            self.i += 1
            if op == "not":
                self.need("in")
            elif op == "is":
                self.take("not")
            self.expression(11 if op == "**" else p + 1)

    def unary(self):
        t = self.t
        while t[self.i] in ("not", "-", "+", "~", "await"):
            if t[self.i] == "not":
                self.i += 1
                return self.expression(4)
            self.i += 1
        x = t[self.i]
        if x in self.SOFT or x in ("0", "s", "True", "False", "None", "..."):
            self.i += 1
        elif x == "(":
            self.i += 1
            if t[self.i] == "yield":
                self.yields()
            elif t[self.i] != ")":
                self.items(")")
            self.need(")")
        elif x == "[":
            self.i += 1
            self.items("]")
            self.need("]")
        elif x == "{":
            self.i += 1
            pairs = None  # a dictionary, a set, or not known yet
            while t[self.i] != "}":
                if t[self.i] in ("**", "*"):
                    pair = t[self.i] == "**"
                    self.i += 1
                    self.expression(5)
                else:
                    self.named()
                    pair = self.take(":")
                    if pair:
                        self.test()
                if pairs is not None and pair != pairs:
                    self.fail("a dictionary or a set")
                pairs = pair
                if t[self.i] in ("for", "async"):
                    self.comprehension()
                    break
                if not self.take(","):
                    break
            self.need("}")
        else:
            self.fail()
        while True:
            x = t[self.i]
            if x == ".":
                self.i += 1
                self.identifier()
            elif x == "(":
                self.i += 1
                self.arguments()
            elif x == "[":
                self.i += 1
                self.slices()
                self.need("]")
            else:
                return

    def items(self, close: str):
        while self.t[self.i] != close:
            if self.take("*"):
                self.expression(5)
            else:
                self.named()
                if self.t[self.i] in ("for", "async"):
                    return self.comprehension()
            if not self.take(","):
                return

    def comprehension(self):
        while self.t[self.i] in ("for", "async"):
            self.take("async")
            self.need("for")
            self.targets()
            self.need("in")
            self.expression(1)
            while self.take("if"):
                if self.t[self.i] in self.SOFT and self.t[self.i + 1] == ":=":
                    self.i += 2
                self.expression(1)

    def arguments(self):
        t = self.t
        while t[self.i] != ")":
            if t[self.i] in ("*", "**"):
                self.i += 1
                self.test()
            elif t[self.i] in self.SOFT and t[self.i + 1] == "=":
                self.i += 2
                self.test()
            else:
                self.named()
                if t[self.i] in ("for", "async"):
                    self.comprehension()
            if not self.take(","):
                break
        self.need(")")

    def slices(self):
        while True:
            if self.take("*"):
                self.expression(5)
            elif self.t[self.i] != ":":
                self.named()
            while self.take(":"):
                if self.t[self.i] not in (":", "]", ","):
                    self.test()
            if not self.take(",") or self.t[self.i] == "]":
                return


def check_python(text: str) -> list[str]:
    return [w for _, w in Python(_py_tokens(text)).program()]


# --------------------------------------------------------------------------------------------------------- JavaScript

# Words and tokens of JavaScript.
_JS_WORDS = frozenset(
    "async await break case catch class const continue debugger default delete do else export extends false finally for function if import in instanceof let new null of return static super switch this throw true try typeof var void while with yield get set".split()
)
_JS_SOFT = frozenset(["i", "async", "of", "get", "set", "static", "let", "await", "yield"])
_JS_TOKEN = re.compile(
    r"""(?P<blank>[ \t\f\v\xa0﻿]+)|(?P<nl>[\r\n  ]+)|(?P<note>//[^\n\r]*|/\*.*?\*/)|(?P<str>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<num>0[xX][0-9a-fA-F_]+n?|0[bB][01_]+n?|0[oO][0-7_]+n?|(?:\d[\d_]*\.?[\d_]*|\.\d[\d_]*)(?:[eE][+-]?\d+)?n?(?![\w$]))"""
    r"""|(?P<name>\#?[A-Za-z_$ª-￿][\w$]*)|(?P<op>>>>=|\.\.\.|===|!==|\*\*=|<<=|>>=|>>>|&&=|\|\|=|\?\?=|=>|==|!=|<=|>=|&&|\|\||\?\?|\?\.(?!\d)|\+\+|--|\*\*|<<|>>|[-+*/%&|^]=|[-+*/%&|^~!<>()\[\]{},:;.?=@])|(?P<tick>`)|(?P<bad>.)""",
    re.S,
)
_JS_REGEX = re.compile(r"/(?![*/])(?:[^\\/\[\n]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/[a-z]*")


def _js_tokens(text: str) -> tuple[list[str], list[bool]]:
    """Kinds, and whether a line ended before each. A template with substitutions becomes a bracketed sum."""
    out: list[str] = []
    lines: list[bool] = []
    i, n, broke, ticks = 0, len(text), False, []
    if text.startswith("#!"):
        i = text.find("\n") if "\n" in text else n

    def add(kind: str):
        nonlocal broke
        out.append(kind)
        lines.append(broke)
        broke = False

    def template(i: int) -> int:
        while i < n:
            c = text[i]
            if c == "\\":
                i += 2
            elif c == "`":
                ticks.pop()
                add("s")
                add(")")
                return i + 1
            elif c == "$" and text[i + 1 : i + 2] == "{":
                add("s")
                add("+")
                add("(")
                ticks[-1] = 0
                return i + 2
            else:
                i += 1
        add(_BAD_TEXT)
        return n

    while i < n:
        c = text[i]
        if c == "/" and text[i + 1 : i + 2] not in ("/", "*"):
            before = out[-1] if out else ""
            if before not in ("i", "0", "s", ")", "]", "}", "this", "super", "null", "true", "false") and before not in _JS_SOFT or before == "}" and broke:
                m = _JS_REGEX.match(text, i)
                if m:
                    add("s")
                    i = m.end()
                    continue
        m = _JS_TOKEN.match(text, i)
        kind, x, i = m.lastgroup, m.group(), m.end()
        if kind == "blank":
            continue
        if kind == "nl":
            broke = True
        elif kind == "note":
            broke = broke or "\n" in x
        elif kind == "tick":
            add("(")
            ticks.append(0)
            i = template(i)
        elif kind in ("str",):
            add("s")
        elif kind == "num":
            add("0")
        elif kind == "name":
            add(x if x in _JS_WORDS else "i")
        elif kind == "bad":
            add(_BAD_TEXT)
        else:
            if ticks and x == "{":
                ticks[-1] += 1
            elif ticks and x == "}":
                if not ticks[-1]:
                    add(")")
                    add("+")
                    i = template(i)
                    continue
                ticks[-1] -= 1
            add(x)
    return out, lines


class JavaScript(_Parser):
    BINARY = {",": 0, "?": 2, "??": 3, "||": 3, "&&": 4, "|": 5, "^": 6, "&": 7, "==": 8, "!=": 8, "===": 8, "!==": 8, "<": 9, ">": 9, "<=": 9, ">=": 9, "instanceof": 9, "in": 9, "<<": 10, ">>": 10, ">>>": 10, "+": 11, "-": 11, "*": 12, "/": 12, "%": 12, "**": 13} | {
        x: 1 for x in "= += -= *= /= %= **= <<= >>= >>>= &= |= ^= &&= ||= ??=".split()
    }
    RIGHT = frozenset("= += -= *= /= %= **= <<= >>= >>>= &= |= ^= &&= ||= ??= **".split())

    def __init__(self, kinds: list[str], lines: list[bool]):
        super().__init__(kinds)
        self.nl = [*lines, True, True, True, True]
        self.no_in = False

    def program(self):
        t = self.t
        while t[self.i]:
            start = self.i
            try:
                self.statement()
            except (SyntaxFault, RecursionError) as e:
                self.recover(e if isinstance(e, SyntaxFault) else SyntaxFault(start, "nested too deeply"), start)
                if t[self.i] == "}":
                    self.i += 1
        return self.errors

    def end(self):
        """A semicolon, or where one is put automatically."""
        if not self.take(";") and self.t[self.i] not in ("}", "") and not self.nl[self.i]:
            self.fail("expected ; before " + self.t[self.i])

    def block(self):
        self.need("{")
        while self.t[self.i] not in ("}", ""):
            start = self.i
            try:
                self.statement()
            except SyntaxFault as e:
                self.recover(e, start)
        self.need("}")

    def identifier(self):
        if self.t[self.i] not in _JS_SOFT:
            self.fail("expected a name")
        self.i += 1

    def statement(self):
        t = self.t
        x = t[self.i]
        if x == "{":
            self.block()
        elif x == ";":
            self.i += 1
        elif x in ("var", "const") or x == "let" and t[self.i + 1] in ("i", "[", "{", "async", "of", "get", "set"):
            self.i += 1
            self.bindings(x == "const")
            self.end()
        elif x == "function" or x == "async" and t[self.i + 1] == "function" and not self.nl[self.i + 1]:
            self.function(True)
        elif x == "class":
            self.klass(True)
        elif x == "if":
            self.i += 1
            self.parens()
            self.statement()
            if self.take("else"):
                self.statement()
        elif x == "while" or x == "with":
            self.i += 1
            self.parens()
            self.statement()
        elif x == "do":
            self.i += 1
            self.statement()
            self.need("while")
            self.parens()
            self.take(";")
        elif x == "for":
            self.loop()
        elif x == "switch":
            self.i += 1
            self.parens()
            self.need("{")
            while t[self.i] not in ("}", ""):
                if self.take("case"):
                    self.expression()
                elif not self.take("default"):
                    self.fail()
                self.need(":")
                while t[self.i] not in ("case", "default", "}", ""):
                    self.statement()
            self.need("}")
        elif x == "try":
            self.i += 1
            self.block()
            caught = self.take("catch")
            if caught:
                if self.take("("):
                    self.binding()
                    self.need(")")
                self.block()
            if self.take("finally"):
                self.block()
            elif not caught:
                self.fail("try without catch")
        elif x in ("return", "throw"):
            self.i += 1
            if t[self.i] not in (";", "}", "") and not self.nl[self.i]:
                self.expression()
            elif x == "throw":
                self.fail()
            self.end()
        elif x in ("break", "continue"):
            self.i += 1
            if t[self.i] in _JS_SOFT and not self.nl[self.i]:
                self.i += 1
            self.end()
        elif x == "debugger":
            self.i += 1
            self.end()
        elif x == "import" and t[self.i + 1] not in ("(", "."):
            self.i += 1
            if not self.take("s"):
                while True:
                    if self.take("*"):
                        self.need_word()
                        self.identifier()
                    elif t[self.i] == "{":
                        self.names()
                    else:
                        self.identifier()
                    if not self.take(","):
                        break
                self.need_word()
                self.need("s")
            if t[self.i] in ("with", "i") and t[self.i + 1] == "{" and not self.nl[self.i]:
                self.i += 1
                self.literal()
            self.end()
        elif x == "export":
            self.i += 1
            if self.take("default"):
                if t[self.i] in ("function", "class", "async"):
                    self.function(False) if t[self.i] != "class" else self.klass(False)
                else:
                    self.expression(1)
                    self.end()
            elif self.take("*"):
                if t[self.i] == "i" and t[self.i + 1] != "s":
                    self.i += 2
                self.need_word()
                self.need("s")
                self.end()
            elif t[self.i] == "{":
                self.names()
                if t[self.i] == "i" and t[self.i + 1] == "s":
                    self.i += 2
                self.end()
            else:
                if t[self.i] not in ("var", "let", "const", "function", "class", "async"):
                    self.fail()
                self.statement()
        elif x in _JS_SOFT and t[self.i + 1] == ":":
            self.i += 2
            self.statement()
        else:
            self.expression()
            self.end()

    def need_word(self):
        """``from`` or ``as``, which are ordinary names elsewhere."""
        self.need("i")

    def names(self):
        self.need("{")
        while self.t[self.i] != "}":
            self.i += 1
            if self.t[self.i] == "i" and self.t[self.i + 1] not in (",", "}"):
                self.i += 2
            elif self.t[self.i] == "i":
                self.fail()
            if not self.take(","):
                break
        self.need("}")

    def loop(self):
        self.need("for")
        self.take("await")
        self.need("(")
        t = self.t
        self.no_in = True
        if t[self.i] in ("var", "let", "const"):
            self.i += 1
            self.bindings(False)
        elif t[self.i] != ";":
            self.expression()
        self.no_in = False
        if t[self.i] in ("of", "in"):
            self.i += 1
            self.expression()
        else:
            self.need(";")
            if t[self.i] != ";":
                self.expression()
            self.need(";")
            if t[self.i] != ")":
                self.expression()
        self.need(")")
        self.statement()

    def bindings(self, valued: bool):
        while True:
            pattern = self.t[self.i] in ("[", "{")
            self.binding()
            if self.take("="):
                self.expression(1)
            elif (valued or pattern) and self.t[self.i] not in ("of", "in") and not self.no_in:
                self.fail("a value is missing")
            if not self.take(","):
                return

    def binding(self):
        if self.t[self.i] in ("[", "{"):
            self.literal()
        else:
            self.identifier()

    def parens(self):
        self.need("(")
        held, self.no_in = self.no_in, False
        self.expression()
        self.no_in = held
        self.need(")")

    def function(self, named: bool):
        self.take("async")
        self.need("function")
        self.take("*")
        if named or self.t[self.i] != "(":
            self.identifier()
        self.parameters()
        self.body()

    def body(self):
        held, self.no_in = self.no_in, False
        self.block()
        self.no_in = held

    def parameters(self):
        self.need("(")
        held, self.no_in = self.no_in, False
        while self.t[self.i] != ")":
            self.take("...")
            self.binding()
            if self.take("="):
                self.expression(1)
            if not self.take(","):
                break
        self.need(")")
        self.no_in = held

    def key(self):
        x = self.t[self.i]
        if x == "[":
            self.i += 1
            self.expression(1)
            self.need("]")
        elif x in ("s", "0", "i") or x in _JS_WORDS:
            self.i += 1
        elif x == "(":  # a template where a key must stand
            self.fail()
        else:
            self.fail()

    def klass(self, named: bool):
        self.need("class")
        t = self.t
        if named or t[self.i] == "i":
            self.identifier()
        if self.take("extends"):
            self.unary()
        self.need("{")
        while t[self.i] not in ("}", ""):
            if self.take(";"):
                continue
            if t[self.i] == "static" and t[self.i + 1] == "{":
                self.i += 1
                self.block()
                continue
            while t[self.i] in ("static", "async", "get", "set") and t[self.i + 1] not in ("(", "=", ";", "}"):
                self.i += 1
            self.take("*")
            self.key()
            if t[self.i] == "(":
                self.parameters()
                self.body()
            else:
                if self.take("="):
                    self.expression(1)
                self.end()
        self.need("}")

    def literal(self):
        """An array or object, also as a pattern."""
        t = self.t
        held, self.no_in = self.no_in, False
        if self.take("["):
            while t[self.i] != "]":
                if self.take(","):
                    continue
                self.take("...")
                self.expression(1)
                if t[self.i] != "]":
                    self.need(",")
            self.need("]")
        else:
            self.need("{")
            while t[self.i] != "}":
                if self.take("..."):
                    self.expression(1)
                else:
                    plain = t[self.i] in _JS_SOFT and t[self.i + 1] in (",", "}", "=")
                    if plain:
                        self.i += 1
                        if self.take("="):
                            self.expression(1)
                    else:
                        while t[self.i] in ("async", "get", "set") and t[self.i + 1] not in ("(", ":", ",", "}"):
                            self.i += 1
                        self.take("*")
                        self.key()
                        if t[self.i] == "(":
                            self.parameters()
                            self.body()
                        else:
                            self.need(":")
                            self.expression(1)
                if not self.take(","):
                    break
            self.need("}")
        self.no_in = held

    def arrow(self) -> bool:
        """An arrow function, if one begins here."""
        t, i = self.t, self.i
        if t[i] == "async" and t[i + 1] in ("(", "i") and not self.nl[i + 1]:
            i += 1
        if t[i] in _JS_SOFT and t[i + 1] == "=>":
            self.i = i + 2
        elif t[i] == "(":
            depth, j = 0, i
            while t[j]:
                depth += (t[j] in _OPEN) - (t[j] in _CLOSE)
                j += 1
                if not depth:
                    break
            if t[j] != "=>":
                return False
            self.i = i
            self.parameters()
            self.need("=>")
        else:
            return False
        if t[self.i] == "{":
            self.body()
        else:
            self.expression(1)
        return True

    def expression(self, least: int = 0):
        if least <= 1 and self.arrow():
            if least == 0 and self.take(","):
                self.expression(0)
            return
        t = self.t
        if t[self.i] == "yield" and least <= 1:
            self.i += 1
            self.take("*")
            if t[self.i] not in (")", "]", "}", ",", ";", ":", "") and not self.nl[self.i]:
                self.expression(1)
            return
        start = self.i
        self.unary()
        while True:
            op = t[self.i]
            p = self.BINARY.get(op, -1)
            if p < least or op == "in" and self.no_in:
                return
            if p == 1 and t[self.i - 1] not in ("i", "]", "}", ")") and t[self.i - 1] not in _JS_WORDS or p == 1 and t[start] in ("0", "s") and self.i == start + 1:
                self.fail("cannot assign here")
            self.i += 1
            if op == "?":
                held, self.no_in = self.no_in, False
                self.expression(1)
                self.no_in = held
                self.need(":")
                self.expression(1)
            else:
                self.expression(p if op in self.RIGHT else p + 1)

    def unary(self):
        t = self.t
        while t[self.i] in ("!", "~", "+", "-", "++", "--", "typeof", "void", "delete", "await"):
            if t[self.i] == "await" and t[self.i + 1] in (")", ",", ";", "=", "."):
                break
            self.i += 1
        x = t[self.i]
        if x == "new":
            self.i += 1
            if self.take("."):
                self.i += 1
            else:
                self.unary()
                return
        elif x == "function" or x == "async" and t[self.i + 1] == "function":
            self.function(False)
        elif x == "class":
            self.klass(False)
        elif x == "(":
            self.parens()
        elif x in ("[", "{"):
            self.literal()
        elif x in ("0", "s", "this", "super", "null", "true", "false", "import") or x in _JS_SOFT:
            self.i += 1
            if x == "import":
                if t[self.i] not in ("(", "."):
                    self.fail()
        else:
            self.fail()
        while True:
            x = t[self.i]
            if x in (".", "?."):
                self.i += 1
                if x == "?." and t[self.i] in ("(", "["):
                    continue
                if t[self.i] != "i" and t[self.i] not in _JS_WORDS:
                    self.fail()
                self.i += 1
            elif x == "[":
                self.i += 1
                held, self.no_in = self.no_in, False
                self.expression()
                self.no_in = held
                self.need("]")
            elif x == "(":
                self.i += 1
                held, self.no_in = self.no_in, False
                while t[self.i] != ")":
                    self.take("...")
                    self.expression(1)
                    if not self.take(","):
                        break
                self.need(")")
                self.no_in = held
            elif x in ("++", "--") and not self.nl[self.i]:
                self.i += 1
            else:
                return


def check_javascript(text: str) -> list[str]:
    kinds, lines = _js_tokens(text)
    return [w for _, w in JavaScript(kinds, lines).program()]


# ---------------------------------------------------------------------------------------------------------- the table

# The language an extension stands for; C counts as C++.
LANGUAGES = {"c": "C++", "cc": "C++", "cpp": "C++", "cxx": "C++", "c++": "C++", "h": "C++", "hh": "C++", "hpp": "C++", "hxx": "C++", "py": "Python", "js": "JavaScript", "mjs": "JavaScript", "cjs": "JavaScript"}
_CHECKS = {"C++": check_cpp, "Python": check_python, "JavaScript": check_javascript}


def language(path: Column) -> Column:
    """The language of a path's extension, null where it stands for none."""
    ext = F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))
    return F.coalesce(*[F.when(ext.isin([e for e, x in LANGUAGES.items() if x == lang]), lang) for lang in _CHECKS])


def faults(text: str, lang: str) -> list[str]:
    """All syntax errors of a text, the first being their cause."""
    text = text.removeprefix("\ufeff").replace("\r\n", "\n").replace("\r", "\n")
    before = sys.getrecursionlimit()
    sys.setrecursionlimit(max(before, 1_000_000))  # Python's own calls take memory, not stack: some 50,000 nested levels
    try:
        return _CHECKS[lang](text)
    except RecursionError:
        return ["nested too deeply"]
    finally:
        sys.setrecursionlimit(before)


def _judge(batches):
    for b in batches:
        out = [faults(c.decode("utf-8", "replace"), lang) for c, lang in zip(b.column("content").to_pylist(), b.column("language").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [b.column("file_id"), b.column("repo"), b.column("language"), pa.array([len(x) for x in out], pa.int32()), pa.array([x[0] if x else None for x in out], pa.string()), pa.array(out, pa.list_(pa.string()))],
            names=["file_id", "repo", "language", "n_errors", "first_error", "errors"],
        )


def parsed_files(files: DataFrame) -> DataFrame:
    """(file_id, repo, language, n_errors, first_error, errors) of every file in one of the three languages.

    Takes ``file_id, repo, file_path, content``. Null content counts as empty, and empty files are valid; bytes that are
    no UTF-8 are errors where they are no comment or string. Files of other extensions, or with a null path, are left
    out. Repeated rows come out repeatedly; other columns are ignored.
    """
    rows = files.select("file_id", "repo", F.coalesce("content", F.lit(b"")).alias("content"), language(F.col("file_path")).alias("language")).where("language is not null")
    kind = dict(rows.dtypes)["file_id"]
    return rows.mapInArrow(_judge, f"file_id {kind}, repo string, language string, n_errors int, first_error string, errors array<string>")


def acceptance(parsed: DataFrame) -> DataFrame:
    """Files, invalid files and their rate for each repository and language."""
    bad = F.sum((F.col("n_errors") > 0).cast("long"))
    return parsed.groupBy("repo", "language").agg(F.count("*").alias("files"), bad.alias("invalid"), F.round(bad / F.count("*"), 6).alias("invalid_rate"))
