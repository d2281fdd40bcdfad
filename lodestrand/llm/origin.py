"""Generated, minified, vendored and data files, told apart from hand-written source by Re-Pair grammars.

Three grammars are inferred. One, of each file's tokens with names and literals reduced to their kinds: a long rule that is
used again and again covers a generated file. One, of each file's literals: literals that hardly compress, and little
else, make a blob. One, of the comments and paths of many files together: a rule that several repositories share, and
whose text is a tool's or a vendor's mark, makes every file that holds it generated or vendored, as do long exact texts
shared by several repositories. Only minified files are told by the shape of their lines, which no grammar of tokens sees.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut
from .repair import grammars, windows
from .syntax import _CPP_WORDS, language

# What tools and vendors say in comments and name files and folders. They are compared with the text of shared
# rules alone: tokens in lower case, one blank between two, every number written as 0, a name between ^ and / or $.
_GENERATED_SAYS = re.compile(
    r"\bgenerated\b.* do(?: not|n ' t) (?:edit|modify|change)\b|(?:/ /|/ \*) code generated by\b|\bautogenerated\b|< auto -? ?generated|@ generated\b|\bauto - ?generated (?:by|from|file|code)\b|\bautomatically (?:generated|produced|created) (?:by|from)\b"
    r"|\b(?:manual|hand|local) (?:edits|changes) are (?:lost|overwritten)\b|\bchanges (?:made in this file )?will be (?:lost|overwritten)\b|\bedit the (?:template|source|schema) instead\b|# line 0 "
)
_GENERATED_NAME = re.compile(r"\^ (?:gen|generated|autogen|auto _ generated) /|\^ (?:moc|qrc|ui) _|\^ lex \.|\. (?:pb|gen|g|generated)(?: \.|$)|_ (?:generated|autogen)(?: \.|$)|_ pb(?: 0)? \.")
_VENDOR_SAYS = re.compile(
    r"\bbundled copy of [a-z]|\bimported (?:unchanged |unmodified |verbatim )?from upstream\b|\bupstream (?:revision|commit|version)\b|\bvendored (?:copy|from)\b|\blibrary , version 0|\( c \) 0 (?:, 0 |- 0 )*the [a-z][a-z -]* (?:contributors|authors|developers)\b|/ / [a-z]+ v 0 \. 0"
)
_VENDOR_NAME = re.compile(r"\^ (?:third _ ?party|third ?party|0 ?rdparty|vendor|vendored|external|externals|extern|deps|bundled|contrib|node _ modules) /|\b[a-z]+ - (?:v )?0 \. 0(?: \. 0)* /")
_LIBRARY = re.compile(r"\bbundled copy of ([a-z]+)\b|/ / ([a-z]+) v 0 \. 0|\( c \) 0 the ([a-z]+) (?:contributors|authors|developers)\b|\b([a-z]+) - (?:v )?0 \. 0(?: \. 0)* /")
# Each alternative begins with a character of its own, and no part is tried twice, so that code is passed over quickly.
_COMMENT = re.compile(r"""//[^\n]*+|/\*[^*]*+(?:\*(?!/)[^*]*+)*+(?:\*/|\Z)|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|R(?<!\wR)"([^()\\\s]{0,16})\(.*?(?:\)\1"|\Z)""", re.S)
_PY_COMMENT = re.compile(r"""\#[^\n]*+|\"\"\".*?(?:\"\"\"|\Z)|'''.*?(?:'''|\Z)|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'""", re.S)
# What may stand before and between the comments that open a file: directives, blanks, a script's prologue.
_HEAD = re.compile(r"""(?:\s+|//[^\n]*|/\*.*?(?:\*/|\Z)|\#(?:[^\n\\]|\\.)*|(["'])use strict\1;?)*+""", re.S)
_PY_HEAD = re.compile(r"""(?:\s+|\#[^\n]*|\"\"\".*?(?:\"\"\"|\Z)|'''.*?(?:'''|\Z))*+""", re.S)
_TOKEN = re.compile(r"\w+|[\S\n]")  # ends of lines are tokens too, until the literals are known


def _split(text: str, python: bool) -> tuple[str, list[tuple[int, str]], list[str]]:
    """Code with strings cut to empty ones, the comments and where they begin, and the strings. A Python string that is
    a statement of its own is a comment."""
    notes: list[tuple[int, str]] = []
    strings: list[str] = []

    def put(m: re.Match) -> str:
        x = m.group()
        if x[0] in "/#" or python and x[:3] in ('"""', "'''") and not text[text.rfind("\n", 0, m.start()) + 1 : m.start()].strip():
            notes.append((m.start(), x))
            return " "
        strings.append(x)
        return '""'

    return (_PY_COMMENT if python else _COMMENT).sub(put, text), notes, strings


_SAID = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
_GAP = "A"  # ends a path's name, comment or directive; text in lower case has no such token
_DIRECTIVE = re.compile(r"^[ \t]*#[ \t]*line[ \t].*", re.M)
# A line that may be a record of data, not code or prose: values between commas, or one key and its value.
_NUMBER = re.compile(r"\d+")
_CODE_SIGN = set(";{}()=<>\\&|!?@")
_RECORD = re.compile(r"[^,]*(?:,[^,]*)+|\s*(?:- )?[\w.\"'-]+\s*:(?:\s.*)?|\s*\S+\s*")
# Words of the three languages that are no data.
_WORDS = set(_CPP_WORDS) | set("import from def class return if else elif for while try except with as pass in not and or is None True False self function var let const".split())
_LAYOUT = set(",[]:-.")


_PIECE = re.compile(r"\w{1,3}|[^\w\s]")
# What a token is among literals.
_IS_LITERAL, _IS_WORD, _IS_SIGN, _IS_LAYOUT, _IS_END = range(1, 6)


def _literals(code: str, ids: np.ndarray, what: np.ndarray, length: np.ndarray, strings: list[str]) -> tuple[np.ndarray, float]:
    """The literals among the tokens of a file's code, and the share of all literals, strings too, in its characters
    without layout. In lines that hold values or keys and no code the words are literals too."""
    line = np.cumsum(what == _IS_END)
    lines = code.split("\n")
    data = np.zeros(len(lines), bool)
    data[line[what == _IS_WORD]] = True
    data[line[what == _IS_SIGN]] = False
    for k in np.flatnonzero(data).tolist():
        data[k] = _RECORD.fullmatch(lines[k]) is not None
    literal = (what == _IS_LITERAL) | (what == _IS_WORD) & data[line]
    share = sum(map(len, strings)) + int(length[literal].sum())
    other = int(length[~literal & (what != _IS_LAYOUT) & (what != _IS_END)].sum())
    return ids[literal], share / max(1, share + other)


_RUN = 24  # tokens of a run, on average


def _runs(exact: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, owner, tokens) of runs of tokens. A run begins where the hash of four tokens says so, whatever is before
    and behind: equal text has equal runs in every file."""
    n = len(exact)
    if not n:
        return np.empty(0, "u8"), owner, owner
    h = exact.copy()
    for j in range(1, 4):
        h[:-j] += exact[j:] * np.uint64(0x9E3779B97F4A7C15 ** (j + 1) & (1 << 64) - 1)
    first = np.r_[True, owner[1:] != owner[:-1]]
    whole = np.r_[owner[3:] == owner[:-3], np.zeros(min(3, n), bool)] if n > 3 else np.zeros(n, bool)
    start = np.flatnonzero(first | whole & (((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)) % np.uint64(_RUN) == 0))
    size = np.diff(np.r_[start, n])
    power = np.full(size.max(), 0x94D049BB133111EB, "u8")
    power[0] = 1
    power = np.multiply.accumulate(power)
    at = np.arange(n) - np.repeat(start, size)
    return np.add.reduceat((exact ^ (exact >> np.uint64(31))) * power[at], start), owner[start], size


def _heard(parts: list[str]) -> list[str]:
    """The tokens of names or comments, each of these ended by a gap."""
    return _SAID.findall(_NUMBER.sub("0", "".join([f"{x.lower()}\n{_GAP}\n" for x in parts])))


def _says(text: str) -> str | None:
    if text[0] == "~":  # a name; its tokens are marked, so that comments about names share no rule with them
        text = text.replace("~", "")
        return "vendored" if _VENDOR_NAME.search(text) else "generated" if _GENERATED_NAME.search(text) else None
    return "vendored" if _VENDOR_SAYS.search(text) else "generated" if _GENERATED_SAYS.search(text) else None


def _marks(hashes: np.ndarray, seg: np.ndarray, file_of: np.ndarray, word: np.ndarray, words: list[str], files: int) -> list[list[tuple]]:
    """Of each file, the rules it shares with another file of the batch that say what it is: (rule, size, says, library).
    Rules that a shorter rule says are left out."""
    rule, own, begin, size, left = grammars(hashes, seg, together=True).uses
    out: list[list[tuple]] = [[] for _ in range(files)]
    if not len(rule):
        return out
    file = file_of[own]
    order = np.lexsort((file, rule))
    rule, file, begin, size, left = (x[order] for x in (rule, file, begin, size, left))
    first = np.flatnonzero(np.r_[True, rule[1:] != rule[:-1]])
    last = np.r_[first[1:], len(rule)]
    several = file[first] != file[last - 1]
    for a, b in zip(first[several].tolist(), last[several].tolist()):
        n, k = int(size[a]), int(left[a])
        heard = [words[w] for w in word[begin[a] : begin[a] + n].tolist()]
        text = " ".join(heard)
        says = _says(text)
        if says is None or _says(" ".join(heard[:k])) == says or _says(" ".join(heard[k:])) == says:
            continue
        library = _LIBRARY.search(text.replace("~", "")) if says == "vendored" else None
        name = next(x for x in library.groups() if x) if library else None
        for f in np.unique(file[a:b]):
            out[f].append((int(rule[a].view("i8")), int(n), says, name))
    return out


def _features(long_rule: int, instance: int, least_uses: int):
    """Per file: what the rules say, and hashes of the exact text under longer rules and of all runs of tokens."""
    vocabulary, spoken = _Vocabulary(), _Vocabulary()

    def features(b: pa.RecordBatch) -> pa.RecordBatch:
        n = b.num_rows
        ids, rows, literal_ids, n_literals = [np.empty(0, "i4")], [], [np.empty(0, "i4")], []
        said = [np.empty(0, "i4")]  # the tokens of paths, comments and directives
        outer, segments = [], []
        for path, lang, content in zip(*(b.column(c).to_pylist() for c in ("file_path", "language", "content"))):
            text = (content or b"").decode("utf-8", "replace").removeprefix("\ufeff").replace("\r\n", "\n")
            python = lang == "Python"
            code, notes, strings = _split(text, python)
            token = vocabulary.numbers(_TOKEN.findall(code))
            what, length = vocabulary.about(token)
            found, share = _literals(code, token, what, length, strings)
            within = vocabulary.numbers(_PIECE.findall("\n".join(strings)))
            literal_ids += within, found
            n_literals.append(len(within) + len(found))
            ids.append(token[what != _IS_END])
            lines = text.split("\n")
            rows.append((share, max(map(len, lines)) >= 300 and len(text) / len(lines) >= 120 and text.count(" ") < 0.16 * len(text), code.count(";") * 60 >= len(ids[-1]) <= code.count("{") * 200))
            head = (_PY_HEAD if python else _HEAD).match(text).end()
            *folders, name = (path or "").lower().split("/")
            names = [f"^{x}/" for x in folders] + [f"^{name}$"]
            parts = [x for at, x in notes if at < head]
            outer.append(len(names) + len(parts))
            parts += [x for at, x in notes if at >= head] + _DIRECTIVE.findall(code)
            segments.append(len(names) + len(parts))
            heard = [x if x == _GAP else "~" + x for x in _heard(names)] + _heard(parts)
            said.append(spoken.numbers(heard))
        size = np.array([len(x) for x in ids[1:]], "i8")
        token, owner = np.concatenate(ids), np.repeat(np.arange(n), size)
        exact_of, kind_of = vocabulary.hashes()
        exact = exact_of[token]
        kinds = grammars(kind_of[token], owner)
        rule, of, _, under, _ = kinds.uses
        _, at, uses = np.unique(rule ^ (of.astype("u8") * np.uint64(0xBF58476D1CE4E5B9)), return_index=True, return_counts=True)
        often = (under[at] >= long_rule) & (under[at] <= 8 * long_rule) & (uses >= least_uses)
        most = np.zeros(n, "i8")  # tokens under the one rule that covers most, of those used often and not only copied whole
        np.maximum.at(most, of[at[often]], (under[at] * uses)[often])
        _, o, begin, length = kinds.symbols
        pieces: list[dict[int, int]] = [{} for _ in range(n)]  # tokens under the exact texts of longer rules
        at, text = np.flatnonzero(length >= instance), exact.tobytes()
        for k, a, m in zip(o[at].tolist(), begin[at].tolist(), length[at].tolist()):
            h = xxhash.xxh64_intdigest(text[8 * a : 8 * (a + m)]) - (1 << 63)
            pieces[k][h] = pieces[k].get(h, 0) + m
        n_literals = np.array(n_literals, "i8")
        left = grammars(exact_of[np.concatenate(literal_ids)], np.repeat(np.arange(n), n_literals)).symbols[1]
        fresh = np.bincount(left, minlength=n) / np.maximum(1, n_literals)
        word, gap, words = np.concatenate(said), spoken[_GAP], list(spoken)
        end = np.flatnonzero(word == gap)
        segment_size = np.diff(np.r_[-1, end]) - 1
        word = word[word != gap]
        heard = spoken.hashes()[0][word]
        file_of = np.repeat(np.arange(n), segments)
        marks = _marks(heard, np.repeat(np.arange(len(end)), segment_size), file_of, word, words, n)
        per_file = np.r_[0, np.cumsum(np.bincount(np.repeat(file_of, segment_size), minlength=n))]
        hashes, of, size_of = _runs(exact, owner)
        order = np.lexsort((hashes, of))
        hashes, of, size_of = hashes[order], of[order], size_of[order]
        new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])]) if len(of) else np.empty(0, "i8")
        under = np.add.reduceat(size_of, new) if len(of) else size_of
        run = pa.StructArray.from_arrays([pa.array(hashes[new].view("i8"), pa.int64()), pa.array(under, pa.int32())], names=["piece", "n"])
        runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(of[new], np.arange(n + 1)), pa.int32()), run)
        n_pieces = np.r_[0, np.cumsum([len(x) for x in pieces])]
        piece = pa.StructArray.from_arrays([pa.array([h for x in pieces for h in x], pa.int64()), pa.array([k for x in pieces for k in x.values()], pa.int32())], names=["piece", "n"])
        share, minified, statements = list(zip(*rows)) or [()] * 3
        mark = pa.list_(pa.struct([("rule", pa.int64()), ("size", pa.int32()), ("says", pa.string()), ("library", pa.string())]))
        named = [[dict(zip(("rule", "size", "says", "library"), m)) for m in x] for x in marks]
        cols = {
            "tokens": pa.array(size, pa.int64()),
            "rule_reuse": pa.array(most / np.maximum(1, size), pa.float64()),
            "statements": pa.array(statements, pa.bool_()),
            "minified": pa.array(minified, pa.bool_()),
            "literals": pa.array(n_literals, pa.int64()),
            "literal_share": pa.array(share, pa.float64()),
            "literals_left": pa.array(fresh, pa.float64()),
            "marks": pa.array(named, mark),
            "said": pa.ListArray.from_arrays(pa.array(per_file, pa.int32()), pa.array(heard.view("i8"), pa.int64())),
            "segments": pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(segments)], pa.int32()), pa.array(segment_size, pa.int32())),
            "outer": pa.array(outer, pa.int32()),
            "pieces": pa.ListArray.from_arrays(pa.array(n_pieces, pa.int32()), piece),
            "runs": runs,
        }
        return pa.RecordBatch.from_arrays([b.column("file_id"), b.column("repo"), b.column("language"), b.column("file_path"), *cols.values()], names=["file_id", "repo", "language", "file_path", *cols])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):  # the arrays of a grammar stay small
                yield features(b.slice(at, 512))

    return run


_FEATURES = (
    "repo string, language string, file_path string, tokens long, rule_reuse double, statements boolean, minified boolean, literals long, literal_share double, literals_left double,"
    " marks array<struct<rule: long, size: int, says: string, library: string>>, said array<long>, segments array<int>, outer int, pieces array<struct<piece: long, n: int>>, runs array<struct<piece: long, n: int>>"
)


def _told_by(rules):
    """The files that hold one of the rules; a vendor's mark counts in paths and in the comments before the first code."""

    def run(batches):
        vendored, wanted = {h for h, _, says in rules.value if says == "vendored"}, {}
        for h, size, _ in rules.value:
            wanted.setdefault(size, []).append(h)
        wanted = {k: np.sort(np.array(v, "i8").view("u8")) for k, v in wanted.items()}
        for b in batches:
            sizes = b.column("segments").flatten().to_numpy(zero_copy_only=False)
            per_file = b.column("segments").value_lengths().to_numpy(zero_copy_only=False)
            file_of = np.repeat(np.arange(b.num_rows), per_file)
            number = np.arange(len(file_of)) - np.repeat(np.cumsum(per_file) - per_file, per_file)
            outside = number < b.column("outer").to_numpy(zero_copy_only=False)[file_of]
            said = b.column("said").flatten().to_numpy(zero_copy_only=False).view("u8")
            seg, h = windows(said, np.repeat(np.arange(len(sizes)), sizes), wanted)
            h = h.view("i8").tolist()
            hits = {(int(file_of[s]), "vendored" if x in vendored else "generated") for s, x in zip(seg.tolist(), h) if outside[s] or x not in vendored}
            at = [f for f, _ in hits]
            yield pa.RecordBatch.from_arrays([b.column("file_id").take(pa.array(at, pa.int64())), pa.array([x for _, x in hits], pa.string())], names=["file_id", "says"])

    return run


class _Vocabulary(dict):
    """Tokens to small numbers, with the hash of each and of its kind, what it is among literals, and its length."""

    def __init__(self):
        self.fixed = {w: xxhash.xxh64_intdigest(w) for w in _CPP_WORDS}
        self.name, self.number = xxhash.xxh64_intdigest("<name>"), xxhash.xxh64_intdigest("<number>")
        self.begin()

    def begin(self):
        self.clear()
        self.exact, self.kind, self.what, self.length = array("Q"), array("Q"), array("B"), array("q")

    def __missing__(self, x: str) -> int:
        h = xxhash.xxh64_intdigest(x)
        digit, word = x[0].isdigit(), x[0].isalpha() or x[0] == "_"
        self.exact.append(h)
        self.kind.append(self.fixed.get(x) or (self.number if digit else self.name if word else h))
        self.what.append(_IS_LITERAL if digit else _IS_WORD if word and x not in _WORDS else _IS_SIGN if x in _CODE_SIGN else _IS_LAYOUT if x in _LAYOUT else _IS_END if x == "\n" else 0)
        self.length.append(len(x))
        i = self[x] = len(self)
        return i

    def numbers(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), "i4", len(tokens))

    def about(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the tokens are among literals, and their lengths."""
        return np.array(self.what, copy=False)[numbers], np.array(self.length, copy=False)[numbers]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """The two hashes of all numbers; a vocabulary that has grown large is begun anew."""
        out = np.array(self.exact, "u8"), np.array(self.kind, "u8")
        if len(self) > 500_000:
            self.begin()
        return out


def file_origins(
    files: DataFrame, reuse: float = 0.15, least_tokens: int = 150, shared: float = 0.8, repositories: int = 3, long_rule: int = 24, instance: int = 12, least_uses: int = 4, verbatim: float = 0.95,
    marked: int = 2, literal_share: float = 0.75, literals_left: float = 0.4, least_literals: int = 12, rules_at_once: int = 100_000,
) -> DataFrame:
    """(file_id, repo, origin, evidence, rule_reuse, shared_share) with origin one of generated, minified, vendored, blob, handwritten.

    Takes ``file_id, repo, file_path, content``. In this order, a file is

    - a blob if ``literal_share`` of its characters are literals, ``least_literals`` or more, and their grammar leaves
      ``literals_left`` of them or more as symbols (evidence ``literals``);
    - minified by the shape of its lines (``lines``);
    - vendored if it holds a rule of the grammar of paths and comments that ``marked`` repositories share and that is a
      vendor's mark, in its path or before its first code (``shared rule``); if it lies in a directory named like a library
      that such rules of two repositories name (``library folder``); or if instances of rules that make up ``shared`` of it,
      or runs of tokens that make up ``verbatim`` of it, occur with the same text in ``repositories`` or more (``shared text``);
    - generated if it holds a shared rule that is a tool's mark (``shared rule``), or, in C++, one rule of ``long_rule`` or more
      tokens, used ``least_uses`` times or more, covers ``reuse`` of it (``rule reuse``).

    Rule reuse and equal text need files of ``least_tokens``, since short files have few rules and are alike by chance.
    ``shared_share`` is the greater of the two shares of shared text. The grammar of paths and comments is inferred over 512
    files at a time; a mark found in any of these is searched everywhere, ``rules_at_once`` at a time.
    Null content counts as empty, and empty files are hand-written; a null path says nothing. Repeated rows come out
    repeatedly; other columns are ignored.
    """
    spark = files.sparkSession
    rows = files.select("file_id", "repo", "file_path", "content", language(F.col("file_path")).alias("language"))
    kind = dict(rows.dtypes)["file_id"]
    told = cut(rows.mapInArrow(_features(long_rule, instance, least_uses), f"file_id {kind}, {_FEATURES}"))
    rules = cut(told.select("repo", F.inline("marks")).distinct().groupBy("rule", "size", "says", "library").agg(F.count("*").alias("r")).where(F.col("r") >= marked))
    blocks = max(1, -(-rules.count() // rules_at_once))
    held = None
    for k in range(blocks):
        block = [(r[0], r[1], r[2]) for r in rules.where(F.pmod(F.xxhash64("rule"), F.lit(blocks)) == k).select("rule", "size", "says").collect()]
        part = told.select("file_id", "said", "segments", "outer").mapInArrow(_told_by(spark.sparkContext.broadcast(block)), f"file_id {kind}, says string")
        held = part if held is None else held.unionByName(part)
    held = held.groupBy("file_id").agg(F.bool_or(F.col("says") == "vendored").alias("vendor_mark"), F.bool_or(F.col("says") == "generated").alias("generated_mark"))
    tagged = lambda c, ruled: F.transform(c, lambda x: F.struct(x["piece"].alias("piece"), x["n"].alias("n"), F.lit(ruled).alias("ruled")))
    piece = told.select("file_id", "repo", F.inline(F.concat(tagged("pieces", True), tagged("runs", False))))
    wide = piece.select("piece", "repo").distinct().groupBy("piece").agg(F.count("*").alias("r")).where(F.col("r") >= repositories).select("piece")
    under = lambda ruled: F.sum(F.when(F.col("ruled") == ruled, F.col("n")))
    share = piece.join(wide, "piece", "left_semi").distinct().groupBy("file_id").agg(under(True).alias("common"), under(False).alias("copied"))
    named = rules.where("library is not null").select(F.col("library").alias("folder")).distinct()
    folders = told.select("file_id", F.explode(F.array_distinct(F.slice(F.split(F.lower("file_path"), "/"), 1, F.greatest(F.lit(0), F.size(F.split("file_path", "/")) - 1)))).alias("folder"))
    inside = folders.join(named, "folder", "left_semi").select("file_id").distinct().withColumn("in_library", F.lit(True))
    out = told.drop("said", "segments", "marks").join(share, "file_id", "left").join(inside, "file_id", "left").join(held, "file_id", "left")
    part = F.coalesce(F.col("common"), F.lit(0)) / F.greatest(F.lit(1), F.col("tokens"))
    run_part = F.coalesce(F.col("copied"), F.lit(0)) / F.greatest(F.lit(1), F.col("tokens"))
    long = F.col("tokens") >= least_tokens
    is_blob = (F.col("literal_share") >= literal_share) & (F.col("literals_left") >= literals_left) & (F.col("literals") >= least_literals)
    copied = ((part >= shared) | (run_part >= verbatim)) & long
    regular = F.col("statements") & (F.col("rule_reuse") >= reuse) & long & (F.col("language") == "C++")
    why = (
        F.when(is_blob, "blob:literals")
        .when(F.col("minified"), "minified:lines")
        .when(F.col("vendor_mark"), "vendored:shared rule")
        .when(F.col("in_library"), "vendored:library folder")
        .when(copied, "vendored:shared text")
        .when(F.col("generated_mark"), "generated:shared rule")
        .when(regular, "generated:rule reuse")
        .otherwise("handwritten:")
    )
    told_as = F.split(why, ":")
    return out.select("file_id", "repo", told_as[0].alias("origin"), F.when(told_as[1] != "", told_as[1]).alias("evidence"), F.round("rule_reuse", 6).alias("rule_reuse"), F.round(F.greatest(part, run_part), 6).alias("shared_share"))
