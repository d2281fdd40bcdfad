"""Garbled text from a wrong character encoding: find it and restore it.

A code-page swap is a substitution cipher: bytes written in one code page were read in another. Which swaps happened is
hidden and differs by source. All work is done on the distinct words of each source. The letter bigrams of all words are
the language model; expectation maximisation learns together how much of each source each swap garbled, backed off to the
whole corpus, and the letter bigrams of the text as it was before. Known code pages are only where it starts from: words
that no known swap explains are deciphered by a table from garbled characters to letters, learnt for each source by the
forward-backward algorithm, and read with translate().
"""

from __future__ import annotations

import math
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut, lookup
from .common import add_counts, pack_counts

# The swaps that are considered, as (read as, written as).
_AS_UTF8 = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "mac_cyrillic", "gbk", "cp932", "big5")
SWAPS: list[tuple[str, str]] = [(x, "utf-8") for x in _AS_UTF8] + [
    ("cp1252", "cp1251"), ("cp1252", "koi8-r"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1251"), ("koi8-r", "cp866"), ("cp866", "koi8-r"),
    ("cp1251", "mac_cyrillic"), ("mac_cyrillic", "cp1251"), ("cp1251", "iso8859-5"), ("iso8859-5", "cp1251"), ("cp1252", "cp866"), ("mac_roman", "cp1251"),
    ("cp1252", "cp1250"), ("cp1252", "iso8859-2"), ("cp1250", "iso8859-2"), ("iso8859-2", "cp1250"), ("cp1250", "cp1252"), ("cp437", "cp1250"), ("cp852", "cp1250"), ("cp1250", "cp852"),
    ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1252", "cp850"), ("cp1251", "cp1252"), ("koi8-r", "cp1252"),
    ("cp1252", "gbk"), ("cp1252", "cp932"), ("cp1252", "euc_jp"), ("cp1252", "big5"), ("cp1251", "gbk"), ("mac_roman", "gbk"), ("gbk", "cp932"), ("gbk", "euc_jp"), ("cp932", "gbk"), ("gbk", "big5"), ("big5", "gbk"),
]
_MULTI = {"gbk", "cp932", "euc_jp", "big5", "utf-8"}
PAIRS, CHARS, BLOCK = 1 << 20, 1 << 16, 1 << 12  # size of the model, whatever the data
_TICKS = re.compile(r"(`+)[^\n]*?\1")
_SPACE = re.compile(r"[ \t\r\n\f\v]+")
# Blocks of the readings that keep a Cyrillic or Chinese word out of the model; any reading may be chosen.
_UNLIKELY = re.compile("[^\\x00-\\x7f\\xa0-\u017f\u0391-\u03c9\u0400-\u045f\u0490\u0491\u2010-\u2044\u20ac\u2116\u2122\u2190-\u22ff\u2500-\u257f\u25a0-\u26ff\u2713-\u2718\u3000-\u30ff\u4e00-\u9fff\uff00-\uff60\U0001f300-\U0001f6ff]")
_LATIN = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "iso8859-2")
# A UTF-8 sequence of several bytes, each byte as the character of its number.
_SEQUENCE = re.compile("(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+")
_FOREIGN = re.compile("[^\x00-\x7f]+")


def _no_text() -> re.Pattern:
    """Characters that no text has: controls, surrogates, private and unassigned ones."""
    none = [unicodedata.category(chr(c)) in ("Cc", "Cn", "Co", "Cs") and c not in (9, 10, 13) for c in range(0x110000)]
    edges = [c for c in range(0x110001) if (c < 0x110000 and none[c]) != (c > 0 and none[c - 1])]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2])) + "]")


def _charmap(page: str) -> dict[int, int]:
    """Characters to bytes, with the bytes a page leaves undefined standing for themselves, as browsers read them."""
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(page)
        except UnicodeDecodeError:
            c = chr(b)
        out[ord(c)] = b
    if page == "cp1252":
        out |= {b: b for b in range(128, 160)}  # a text read as Latin-1 keeps these as control characters
    return out


def _tables() -> dict[str, dict[int, int]]:
    return {p: _charmap(p) for p in {r for r, _ in SWAPS} if p not in _MULTI}


def _translation(read: str, written: str) -> dict[int, str | None]:
    """The substitution cipher of a swap between single-byte pages, for ``str.translate``."""
    out: dict[int, str | None] = {}
    for c, b in _charmap(read).items():
        try:
            out[c] = bytes([b]).decode(written)
        except UnicodeDecodeError:
            out[c] = "�"
    return out


class Restorer:
    """Undo swaps of single words; built once per task."""

    def __init__(self):
        self.bytes_of = _tables()
        self.no_text = _no_text()
        self.byte_chars = {p: {c: 0x100 for c in range(128, 256)} | t for p, t in self.bytes_of.items()}
        self.stretches = {p: re.compile("[" + "".join(map(re.escape, map(chr, t))) + "]{2,}") for p, t in self.bytes_of.items()}
        self.ciphers = {(r, w): _translation(r, w) for r, w in SWAPS if r not in _MULTI and w not in _MULTI}

    def undo(self, word: str, swap: int) -> str | None:
        """The word before the swap, or with what stretches of it were before; None if this swap can't have made any."""
        out = self.whole(word, swap)
        if out is not None:
            return out
        read, written = SWAPS[swap]
        if read in _MULTI:
            if _FOREIGN.fullmatch(word):
                return None
            out = _FOREIGN.sub(lambda m: self.whole(m.group(), swap) or m.group(), word)
        elif written == "utf-8":
            raw, out, last = word.translate(self.byte_chars[read]), "", 0
            for m in _SEQUENCE.finditer(raw):
                out += word[last : m.start()] + m.group().encode("latin-1").decode("utf-8")
                last = m.end()
            out += word[last:]
        else:
            out = self.stretches[read].sub(lambda m: self.whole(m.group(), swap) or m.group(), word)
        return None if out == word else out

    def likely(self, text: str) -> bool:
        return not self.no_text.search(text)

    def whole(self, word: str, swap: int) -> str | None:
        """The word before the swap of all of it."""
        read, written = SWAPS[swap]
        if (read, written) in self.ciphers:
            out = word.translate(self.ciphers[read, written])
            known = self.bytes_of[read]
            if out == word or "�" in out or any(ord(c) > 127 and ord(c) not in known for c in word):
                return None
            return out
        try:
            if read in _MULTI:
                raw = word.encode(read)
            else:
                table = self.bytes_of[read]
                raw = bytes([ord(c) if ord(c) < 128 else table[ord(c)] for c in word])
            out = raw.decode(written)
        except (UnicodeError, KeyError):
            return None
        if out == word:
            return None
        return out


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each between ^ and $, and the word each belongs to."""
    x = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), "u4").astype("i8")
    return x, np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * 0x9E3779B1 ^ b * 0x85EBCA6B) >> 5 & (PAIRS - 1)


def _tally(batches):
    """Weighted counts of the letter bigrams and letters of (word, n)."""
    counts = np.zeros(PAIRS + CHARS)
    for batch in batches:
        words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy(zero_copy_only=False)
        if not words:
            continue
        x, of = _codes(words)
        weight, inside = n[of].astype("f8"), of[1:] == of[:-1]
        np.add.at(counts, _pair(x[:-1], x[1:])[inside], weight[1:][inside])
        np.add.at(counts, PAIRS + (x & (CHARS - 1)), weight)
    yield pack_counts(counts, BLOCK)


def _counted(rows: DataFrame) -> np.ndarray:
    return add_counts(rows.select("word", F.col("n").cast("double").alias("n")).mapInArrow(_tally, "block int, counts binary"), PAIRS + CHARS, BLOCK)


class Model:
    """Log-likelihoods of words by their letter bigrams."""

    def __init__(self, counts: np.ndarray):
        counts = np.maximum(0, counts)
        self.pairs, self.chars = counts[:PAIRS], counts[PAIRS:]
        self.total = max(1.0, self.chars.sum())

    def steps(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        plain = (self.chars[b & (CHARS - 1)] + 0.02) / (self.total + 0.02 * CHARS)
        return np.log((self.pairs[_pair(a, b)] + 4 * plain) / (self.chars[a & (CHARS - 1)] + 4))

    def scores(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.empty(0)
        x, of = _codes(words)
        inside = of[1:] == of[:-1]
        return np.bincount(of[1:][inside], self.steps(x[:-1], x[1:])[inside], len(words))


def _explained(batches):
    """Whether a swap from UTF-8 explains a whole word; such words are no model of a language to begin with."""
    r = Restorer()
    utf8 = [k for k, (_, b) in enumerate(SWAPS) if b == "utf-8"]
    for batch in batches:
        words = batch.column("word").to_pylist()
        flag = [any((x := r.whole(w, k)) and (r.likely(x) if SWAPS[k][0] in _LATIN else not _UNLIKELY.search(x)) for k in utf8) for w in words]
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(flag, pa.bool_())], names=["word", "n", "explained"])


_OPTIONS = "array<struct<swap: int, reading: string, gain: double>>"
_OPTION_TYPE = pa.list_(pa.struct([("swap", pa.int32()), ("reading", pa.string()), ("gain", pa.float64())]))


def _readings(counts, floor: float):
    """What each swap makes of each word, with the gain in log-likelihood over leaving it."""

    def run(batches):
        model, r = Model(counts.value), Restorer()
        for batch in batches:
            words = batch.column("word").to_pylist()
            stay = model.scores(words)
            best: dict[tuple[int, int], tuple[float, str]] = {}
            todo = [(i, k, w, -math.inf) for i, w in enumerate(words) for k in range(len(SWAPS))]
            while todo:  # a word may have been read wrongly more than once
                made = [(i, k, x, before) for i, k, now, before in todo if not now.isascii() and (x := r.undo(now, k)) is not None]
                score = model.scores([x for _, _, x, _ in made]).tolist()
                todo = []
                for (i, k, x, before), s in zip(made, score):
                    if r.likely(x) and s > best.get((i, k), (-math.inf, ""))[0]:
                        best[i, k] = s, x
                    # Readings as UTF-8 get shorter and so end; other swaps are undone again while the text gets better.
                    if SWAPS[k][1] == "utf-8" and len(x) < len(words[i]) or s > before + 1e-9 and s > stay[i]:
                        todo.append((i, k, x, s))
            out: list[list[dict]] = [[] for _ in words]
            for (i, k), (s, x) in best.items():
                if s - stay[i] > floor:
                    out[i].append({"swap": k, "reading": x, "gain": s - stay[i]})
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("explained"), pa.array(stay, pa.float64()), pa.array(out, _OPTION_TYPE)], names=["word", "explained", "score", "options"])

    return run


def _rescored(counts):
    """The gains anew, by the model of this round."""

    def run(batches):
        model = Model(counts.value)
        for batch in batches:
            words, options = batch.column("word").to_pylist(), batch.column("options").to_pylist()
            stay = model.scores(words)
            score = iter(model.scores([o["reading"] for x in options for o in x]).tolist())
            for x, s in zip(options, stay.tolist()):
                for o in x:
                    o["gain"] = next(score) - s
            at = batch.schema.names.index
            batch = batch.set_column(at("score"), "score", pa.array(stay, pa.float64()))
            yield batch.set_column(at("options"), "options", pa.array(options, _OPTION_TYPE))

    return run


def _judged(words: DataFrame, share: DataFrame | None) -> DataFrame:
    """``words`` with ``post``, the posterior of each option; what is missing to 1 is that of leaving the word."""
    start = F.lit(0.01 / len(SWAPS))
    if share is None:
        prior = lambda o: start
    else:
        words = lookup(words, share, "source", written=True)
        prior = lambda o: F.coalesce(F.try_element_at("share", o["swap"]), start)
    w = F.transform("options", lambda o: prior(o) * F.exp(F.least(o["gain"], F.lit(200.0))))
    judged = words.withColumn("_w", w).withColumn("_z", F.aggregate("_w", F.lit(1.0), lambda s, x: s + x))
    return judged.withColumn("post", F.transform("_w", lambda x: x / F.col("_z"))).drop("_w", "_z", "share")


def _shares(judged: DataFrame, totals: DataFrame, backoff: float) -> DataFrame:
    """(source, share): the share of each source's words that each swap garbled, backed off to the share in all sources."""
    each = judged.select("source", F.posexplode("options").alias("i", "o"), "post", "n")
    mass = cut(each.groupBy("source", F.col("o.swap").alias("swap")).agg(F.sum(F.col("n") * F.get("post", F.col("i"))).alias("e")))
    every = totals.agg(F.sum("all_words")).first()[0] or 1
    common = mass.groupBy("swap").agg((F.sum("e") / every).alias("c"))  # one row for each swap
    smoothed = lookup(mass.join(F.broadcast(common), "swap"), totals, "source", written=True).withColumn("share", (F.col("e") + backoff * F.col("c") + 1e-6) / (F.col("all_words") + backoff))
    return cut(smoothed.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("swap", "share"))).alias("share")))


def _expected(judged: DataFrame) -> DataFrame:
    """(word, n): the words and readings as they are expected to have been."""
    left = F.greatest(F.lit(0.0), 1 - F.aggregate("post", F.lit(0.0), lambda s, x: s + x))
    stay = judged.select("word", (F.col("n") * left).alias("n"))
    read = judged.select(F.posexplode("options").alias("i", "o"), "post", "n").select(F.col("o.reading").alias("word"), (F.col("n") * F.get("post", F.col("i"))).alias("n"))
    return stay.unionByName(read).where("n > 1e-6")


# -- ciphers of no known page

FREE = len(SWAPS)


class _Alphabet:
    """The letters a cipher may stand for: those of alphabets, as often as ``least`` in the text or more. The scripts that one
    byte can't hold (Chinese, Japanese, Korean) are none; of all others, two code pages full of letters are enough."""

    def __init__(self, model: Model, least: float = 2e-6, most: int = 256):
        order = np.argsort(-model.chars, kind="stable").tolist()
        often = [c for c in order if c > 127 and model.chars[c] > least * model.total and unicodedata.category(chr(c))[0] in "LM" and not (0x2E80 <= c <= 0xA4CF or 0xAC00 <= c <= 0xD7FF or 0xF900 <= c <= 0xFAFF)]
        self.letters = sorted(often[:most])
        states = np.array(list(range(128)) + self.letters, "i8")
        a, b = np.meshgrid(states, states, indexing="ij")
        self.step = np.exp(model.steps(a, b))


def _seeds(symbol: str) -> set[str]:
    """What known pages make of a character: where learning starts."""
    out = set()
    for read, written in SWAPS:
        if read not in _MULTI and written not in _MULTI and symbol in (t := _translation_of(read, written)):
            out.add(t[symbol])
    return out


@lru_cache(maxsize=None)
def _translation_of(read: str, written: str) -> dict[str, str | None]:
    return {chr(c): x for c, x in _translation(read, written).items()}


_TABLE = "source string, parts int, symbol string, letter string, e double"


def _decipher(counts, common: dict[tuple[str, str], float]):
    """One round of forward and backward over odd words of a source: the expected uses of each letter by each symbol, from
    those of the round before and what is ``common`` to all sources."""

    def round_(odd: pa.Table, table: pa.Table) -> pa.Table:
        if not odd.num_rows:
            return pa.table({"source": pa.array([], pa.string()), "parts": pa.array([], pa.int32()), "symbol": pa.array([], pa.string()), "letter": pa.array([], pa.string()), "e": pa.array([], pa.float64())})
        alphabet = _Alphabet(Model(counts.value))
        states, n_letters = 128 + len(alphabet.letters), len(alphabet.letters)
        words, n = odd.column("word").to_pylist(), odd.column("n").to_numpy()
        symbols = sorted({c for w in words for c in w if ord(c) > 127})
        place = {c: 128 + i for i, c in enumerate(symbols)}
        at_letter = {chr(c): i for i, c in enumerate(alphabet.letters)}
        emit = np.zeros((n_letters, len(symbols)))
        if table.num_rows:
            for c, l, e in zip(table.column("symbol").to_pylist(), table.column("letter").to_pylist(), table.column("e").to_pylist()):
                if c in place and l in at_letter:
                    emit[at_letter[l], place[c] - 128] += e
            for (c, l), e in common.items():
                if c in place and l in at_letter:
                    emit[at_letter[l], place[c] - 128] += e
            emit += 1e-4
        else:
            emit += 0.05
            for c in symbols:
                for l in _seeds(c):
                    if l in at_letter:
                        emit[at_letter[l], place[c] - 128] += 1
        emit /= np.maximum(emit.sum(axis=1, keepdims=True), 1e-9) if n_letters else 1
        seen = np.zeros((128 + len(symbols), states))
        seen[np.arange(128), np.arange(128)] = 1
        seen[128:, 128:] = emit.T
        total = np.zeros((len(symbols), states))
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w), []).append(i)
        for size, rows in by_size.items():
            together = max(1, 16_384 // (size + 2))  # long words take as much memory as many short ones
            for s in range(0, len(rows), together):
                some = rows[s : s + together]
                obs = np.array([[ord("^")] + [place.get(c, ord(c)) for c in words[i]] + [ord("$")] for i in some])
                fore = [seen[obs[:, 0]]]
                for t in range(1, size + 2):
                    x = (fore[-1] @ alphabet.step) * seen[obs[:, t]]
                    fore.append(x / np.maximum(x.sum(axis=1, keepdims=True), 1e-300))
                back = np.ones((len(some), states))
                for t in range(size, 0, -1):
                    back = (back * seen[obs[:, t + 1]]) @ alphabet.step.T
                    back /= np.maximum(back.max(axis=1, keepdims=True), 1e-300)
                    post = fore[t] * back
                    post *= n[some][:, None] / np.maximum(post.sum(axis=1, keepdims=True), 1e-300)
                    odd_one = obs[:, t] > 127
                    np.add.at(total, obs[odd_one, t] - 128, post[odd_one])
        c, l = np.nonzero(total[:, 128:] > 1e-3)
        return pa.table(
            {
                "source": pa.array([odd.column("source")[0].as_py()] * len(c), pa.string()),
                "parts": pa.array([odd.column("parts")[0].as_py()] * len(c), pa.int32()),
                "symbol": pa.array([symbols[i] for i in c], pa.string()),
                "letter": pa.array([chr(alphabet.letters[i]) for i in l], pa.string()),
                "e": pa.array(total[c, 128 + l], pa.float64()),
            }
        )

    return round_


def _odd_words(judged: DataFrame, lift: float) -> DataFrame:
    """The words that no known swap explains and whose characters beyond ASCII may all come from one byte and are each at
    least ``lift`` times as frequent in their source as in all others."""
    bytes_ = "".join(sorted({chr(c) for t in _tables().values() for c in t if c > 127}))
    single = F.length(F.translate("word", bytes_, "")) == F.length(F.regexp_replace("word", r"[^\x00-\x7f]", ""))
    known = F.aggregate("post", F.lit(0.0), lambda s, x: s + x)
    rest = judged.where((known < 0.5) & single)
    used = cut(rest.select("source", "n", F.explode(F.split(F.regexp_replace("word", r"[\x00-\x7f]", ""), "")).alias("symbol")).where("symbol <> ''").groupBy("source", "symbol").agg(F.sum("n").alias("n")))
    of_source, of_symbol = used.groupBy("source").agg(F.sum("n").alias("in_source")), used.groupBy("symbol").agg(F.sum("n").alias("in_all"))
    every = used.agg(F.sum("n")).first()[0] or 0
    rates = lookup(lookup(used, of_source, "source"), of_symbol, "symbol")
    here, there = F.col("n") / F.col("in_source"), (F.col("in_all") - F.col("n") + 1) / (every - F.col("in_source") + 1)
    marked = rates.where(here >= lift * there).groupBy("source").agg(F.array_join(F.collect_list("symbol"), "").alias("marked"))
    return lookup(rest, marked, "source", "inner").where(~F.call_function("translate", F.col("word"), F.col("marked"), F.lit("")).rlike(r"[^\x00-\x7f]")).drop("marked")


def _ciphers(odd: DataFrame, counts: np.ndarray, rounds: int, backoff: float, least_words: int) -> DataFrame | None:
    """(source, symbols, letters): for sources with ``least_words`` odd words or more, what each of their characters most
    likely stands for; None where there is no such source. ``counts`` are those of the text without the odd words."""
    spark = odd.sparkSession
    model = spark.sparkContext.broadcast(counts)
    odd = odd.select("source", "word", F.col("n").cast("double").alias("n"))
    parts = odd.groupBy("source").agg(F.count("*").alias("odd")).where(F.col("odd") >= least_words).select("source", F.ceil(F.col("odd") / 20_000).cast("int").alias("parts"))
    odd = cut(lookup(odd, parts, "source", "inner").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")))
    if odd.isEmpty():
        return None
    learnt, common = None, {}
    for _ in range(rounds):
        table = spark.createDataFrame([], _TABLE + ", part int") if learnt is None else learnt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        made = odd.groupBy("source", "part").cogroup(table.groupBy("source", "part")).applyInArrow(_decipher(model, common), _TABLE)
        learnt = cut(made.groupBy("source", "parts", "symbol", "letter").agg(F.sum("e").alias("e")))
        # What the symbols stand for in all sources: symbols and letters are those of alphabets, so these are few.
        whole: dict[str, dict[str, float]] = {}
        for c, l, e in learnt.groupBy("symbol", "letter").agg(F.sum("e")).where("letter is not null").collect():
            whole.setdefault(c, {})[l] = e
        common = {(c, l): backoff * e / sum(x.values()) for c, x in whole.items() for l, e in x.items()}
    best = learnt.groupBy("source", "symbol").agg(F.max_by("letter", F.struct("e", "letter")).alias("letter"), F.max("e").alias("e"), F.sum("e").alias("all")).where("e >= 0.5 * all and letter <> symbol")
    rows = best.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("symbol", "letter"))).alias("x"))
    return cut(rows.select("source", F.array_join("x.symbol", "").alias("symbols"), F.array_join("x.letter", "").alias("letters")))


def _cipher_options(odd: DataFrame, ciphers: DataFrame, counts: np.ndarray, natural: float, least_words: int) -> DataFrame | None:
    """(source, word, more): the odd words with the reading by their source's cipher as a further option, where the cipher
    pays: it must gain more than its table costs, read ``least_words`` words clearly better and few worse, and what it
    reads must be about as likely a letter as other text, which costs ``natural`` nats. None if no cipher does."""
    model = odd.sparkSession.sparkContext.broadcast(counts)
    read = lookup(odd, ciphers, "source", "inner", written=True).withColumn("reading", F.call_function("translate", F.col("word"), F.col("symbols"), F.col("letters"))).where("reading <> word")
    trial = read.select("source", "word", "symbols", "score", F.array(F.struct(F.lit(FREE).alias("swap"), "reading", F.lit(0.0).alias("gain"))).cast(_OPTIONS).alias("options"))
    scored = cut(trial.mapInArrow(_rescored(model), trial.schema).withColumn("gain", F.get("options", F.lit(0))["gain"]))
    cost = F.length(F.first("symbols")) * math.log(200)
    likely = -F.sum(F.col("score") + F.col("gain")) / F.sum(F.length("word") + 1)
    pays = scored.groupBy("source").agg((F.sum("gain") - 2 * cost).alias("won"), F.count_if(F.col("gain") > 5).alias("better"), F.count_if(F.col("gain") < 0).alias("worse"), likely.alias("likely"))
    pays = pays.where((F.col("won") > 0) & (F.col("better") >= least_words) & (F.col("better") > 4 * F.col("worse")) & (F.col("likely") < 1.5 * natural)).select("source")
    added = cut(lookup(scored, pays, "source", "left_semi").select("source", "word", F.col("options").alias("more")))
    return None if added.isEmpty() else added


# -- documents

_JAVA_TICKS, _JAVA_SPACE = r"(`+)[^\n]*?\1", "[ \\t\\r\\n\\f\\x0B`]+"


def _plain(text: str):
    return F.regexp_replace(text, _JAVA_TICKS, " ")


def _replaced(batches):
    """Every word that has a reading gets it, but for what stands between backticks."""
    for b in batches:
        new, hits = [], []
        for text, fixes in zip(b.column("text").to_pylist(), b.column("fixes").to_pylist()):
            n = 0
            if fixes:
                known = dict(fixes)

                def fix(m: re.Match) -> str:
                    nonlocal n
                    out = known.get(m.group())
                    n += out is not None
                    return m.group() if out is None else out

                text = _PARTS.sub(fix, text)
            new.append(text)
            hits.append(n)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x or k > 0 for x, k in zip(b.column("lost").to_pylist(), hits)], pa.bool_()), pa.array(hits, pa.int32()), pa.array(new, pa.string())], names=["doc_id", "garbled", "words", "restored"])


_PARTS = re.compile(r"(`+)[^\n]*?\1|[^ \t\r\n\f\v`]+|`+")


def garbled_words(texts: DataFrame, rounds: int = 3, least: float = 0.5, backoff: float = 20.0, cipher_rounds: int = 16, lift: float = 5.0, least_words: int = 20) -> DataFrame:
    """(source, word, reading) of the distinct words of ``texts`` (text, source) that are garbled; see ``restored_documents``."""
    spark = texts.sparkSession
    each = texts.select("source", F.explode(F.split(_plain("text"), _JAVA_SPACE)).alias("word")).where("word <> ''")
    foreign = F.col("word").rlike(r"[^\x00-\x7f]")
    vocabulary = cut(each.withColumn("source", F.when(foreign, F.col("source"))).groupBy("source", "word").agg(F.count("*").alias("n")))
    mine = vocabulary.where("source is not null")
    totals = cut(mine.groupBy("source").agg(F.sum("n").alias("all_words")))
    distinct = cut(mine.groupBy("word").agg(F.sum("n").alias("n")).mapInArrow(_explained, "word string, n long, explained boolean"))
    counts = _counted(vocabulary.where("source is null").select("word", "n").unionByName(distinct.where("not explained").select("word", "n")))
    read = distinct.mapInArrow(_readings(spark.sparkContext.broadcast(counts), -3.0), f"word string, explained boolean, score double, options {_OPTIONS}")
    words = cut(mine.join(read, "word").select("source", "word", "n", "explained", "score", "options"))
    unsure = F.size("options") > 0
    fixed = counts - _counted(words.where(unsure & ~F.col("explained")))
    share = None

    def learn(words: DataFrame, share: DataFrame | None, counts: np.ndarray):
        for _ in range(rounds):
            judged = _judged(words.where(unsure), share)
            share = _shares(judged, totals, backoff)
            counts = fixed + _counted(_expected(judged))
            words = cut(words.mapInArrow(_rescored(spark.sparkContext.broadcast(counts)), words.schema))
        return words, share, counts

    words, share, counts = learn(words, share, counts)
    if rounds and cipher_rounds:
        odd = cut(_odd_words(_judged(words, share), lift))
        known = counts if odd.isEmpty() else counts - _counted(_expected(odd))
        ciphers = _ciphers(odd, known, cipher_rounds, backoff, least_words)
        if ciphers is not None:
            usual = words.where(~F.col("explained")).join(odd.select("source", "word"), ["source", "word"], "left_anti").agg(-F.sum(F.col("score") * F.col("n")) / F.sum(F.col("n") * (F.length("word") + 1))).first()[0]
            more = _cipher_options(odd, ciphers, known, usual or 0.0, least_words)
            if more is not None:
                more = cut(lookup(words, more, ["source", "word"], written=True))
                fixed = fixed - _counted(more.where(F.col("more").isNotNull() & (F.size("options") == 0) & ~F.col("explained")))
                words = more.withColumn("options", F.concat("options", F.coalesce("more", F.array().cast(_OPTIONS)))).drop("more")
                words, share, counts = learn(words, share, counts)
    judged = _judged(words.where(unsure), share)
    best = F.array_max(F.transform("options", lambda o, i: F.struct(F.get("post", i).alias("post"), o["reading"].alias("reading"))))
    left = 1 - F.aggregate("post", F.lit(0.0), lambda s, x: s + x)
    return cut(judged.where(1 - left >= least).select("source", "word", best["reading"].alias("reading")))


def restored_documents(documents: DataFrame, rounds: int = 3, least: float = 0.5, **learning) -> DataFrame:
    """(doc_id, garbled, words, restored) of every document: whether it holds garbled text, in how many words, and the
    text with those words restored.

    Takes ``doc_id, text, source``; sources are compared trimmed and in lower case, and null is a source of its own.
    Null text counts as empty. What stands between backticks is an example and left alone. Replacement characters make
    a document garbled, though what they replaced is lost. ``rounds`` of EM learn the swaps of each source and the
    letters; a source's shares are those of all sources until it has clearly more than ``backoff`` words. A word counts as
    garbled from a posterior of ``least``. Ciphers of no known page are learnt in ``cipher_rounds`` from words whose characters
    are ``lift`` times as frequent in their source as elsewhere; one is used where it reads ``least_words`` distinct words better. Repeated rows come out
    repeatedly; an empty table gives none; other columns are ignored.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.lower(F.trim("source")), F.lit("")).alias("source"))
    wrong = garbled_words(texts.select("text", "source"), rounds, least, **learning)
    key = ["source", "h1", "h2"]
    hashed = texts.withColumns({"h1": F.xxhash64("text"), "h2": F.hash("text")})
    foreign = F.filter(F.array_distinct(F.split(_plain("text"), _JAVA_SPACE)), lambda w: w.rlike(r"[^\x00-\x7f]"))
    spots = lookup(hashed.select(*key, F.explode(foreign).alias("word")), wrong, ["source", "word"], "inner", written=True)
    fixes = spots.groupBy(*key).agg(F.map_from_entries(F.collect_set(F.struct("word", "reading"))).alias("fixes"))
    rows = lookup(hashed, fixes, key).select("doc_id", "text", "fixes", F.contains(_plain("text"), F.lit("�")).alias("lost"))
    kind = dict(texts.dtypes)["doc_id"]
    return rows.mapInArrow(_replaced, f"doc_id {kind}, garbled boolean, words int, restored string")
