"""Classes, structs and functions of C++ files, by a scanner that skips comments, strings and bodies.

Namespaces qualify names; class bodies are not entered, so methods defined inside are no entities; templates begin at
their outermost ``template``. Errors leave the rest of the file readable.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.comments import clean_doxygen, signature_source
from ..functions.uri import cpp_name, global_uri, signature_hash
from ..plans.session import spread

# What is taken for C++, and directories that are not entered.
EXTENSIONS = (".cpp", ".cc", ".cxx", ".h", ".hpp", ".hxx", ".c")
SKIPPED = ("build", "cmake-build-debug", "cmake-build-release", "node_modules", "venv", "__pycache__", "dist", "out")
_LEX = re.compile(
    r"""(?P<note>//[^\n]*|/\*.*?(?:\*/|\Z))|(?P<text>\bR"(?P<d>[^()\\\s]{0,16})\(.*?(?:\)(?P=d)"|\Z)|"(?:[^"\\\n]|\\.)*"?|'(?:[^'\\\n]|\\.)*'?)|(?P<rule>^[ \t]*\#(?:[^\n\\]|\\.)*)|(?P<word>~?[^\W\d]\w*)|(?P<mark>::|[^\s\w])""",
    re.S | re.M,
)
RAW = "entity_type string, entity_name string, comment string, code_text string, start_line int, end_line int, is_templated boolean, position int, is_declaration boolean, extern_c boolean, errors int"


def _close(tokens: list[re.Match], i: int, a: str, b: str) -> int:
    depth = 0
    for j in range(i, len(tokens)):
        x = tokens[j].group()
        if tokens[j].lastgroup == "mark":
            depth += (x == a) - (x == b)
            if not depth:
                return j
    return -1


def scan(text: str) -> Iterator[tuple]:
    """(type, qualified name, comment, code, first line, last line, templated, position, declared only, in extern "C",
    errors) of every entity and function declaration; one row of nulls and errors where there is none."""
    every = list(_LEX.finditer(text))
    notes = [m for m in every if m.lastgroup == "note"]
    code = [m for m in every if m.lastgroup not in ("note", "rule")]
    starts = [0] + [m.end() for m in re.finditer("\n", text)]
    note_ends = [m.end() for m in notes]

    def line(at: int) -> int:
        return bisect.bisect_right(starts, at)

    def comment(at: int) -> str:
        run, below = [], line(at)
        for k in range(bisect.bisect_right(note_ends, at) - 1, -1, -1):
            m = notes[k]
            if below - line(max(m.start(), m.end() - 1)) > 1 or m.start() < last_end:
                break
            if re.match(r"/\*\*(?!/)|/\*!|///|//!", m.group()):
                run.append(m.group())
            below = line(m.start())
        return "\n".join(reversed(run))

    scopes: list[str | None] = []
    linked: list[bool] = []  # which scopes are extern "C"
    out: list[list] = []
    errors, i, head, last_end = 0, 0, [], 0
    while i < len(code):
        x = code[i].group()
        word = code[i].lastgroup == "word"
        if x == "{" and not word and code[i].lastgroup == "mark":
            words = [m.group() for m in head]
            if "namespace" in words:
                k = words.index("namespace")
                scopes.append("::".join(w for w in words[k + 1 :] if w not in ("::", "inline")) or None)
                linked.append(False)
                head, last_end, i = [], code[i].end(), i + 1
                continue
            if words[:1] == ["extern"] and len(words) == 2 and "(" not in words:
                scopes.append(None)
                linked.append(words[1] == '"C"')
                head, last_end, i = [], code[i].end(), i + 1
                continue
            j = _close(code, i, "{", "}")
            if j < 0:
                errors, j = errors + 1, len(code) - 1
            templated = words[:1] == ["template"]
            plain = list(head)
            while plain and plain[0].group() == "template":
                k = 1
                depth = 0
                while k < len(plain):
                    depth += (plain[k].group() == "<") - (plain[k].group() == ">")
                    k += 1
                    if not depth:
                        break
                plain = plain[k:]
            kind, name = _entity([m.group() for m in plain])
            end = j
            if kind in ("Class", "Struct") and j + 1 < len(code) and code[j + 1].group() == ";":
                end = j + 1
            if kind and name:
                full = "::".join([s for s in scopes if s] + [name])
                begin = head[0].start()
                stop = code[j].end()
                out.append([kind, full, comment(begin), text[begin:stop], line(begin), line(stop - 1), templated, len(out), False, any(linked)])
            if kind == "Function" or kind in ("Class", "Struct") or not kind:
                if not kind and "=" in words:
                    head.append(code[j])
                    i = j + 1
                    continue
            head, last_end, i = [], code[end].end(), end + 1
            continue
        if x == "}" and code[i].lastgroup == "mark":
            if scopes:
                scopes.pop()
                linked.pop()
            else:
                errors += 1
            head, last_end = [], code[i].end()
        elif x == ";" and code[i].lastgroup == "mark":
            if head and (name := _declared(text, head)):
                begin, stop = head[0].start(), code[i].end()
                c_linked = any(linked) or [m.group() for m in head[:2]] == ["extern", '"C"']
                out.append(["Function", "::".join([s for s in scopes if s] + [name]), comment(begin), text[begin:stop], line(begin), line(stop - 1), head[0].group() == "template", len(out), True, c_linked])
            head, last_end = [], code[i].end()
        elif x == "(" and code[i].lastgroup == "mark":
            j = _close(code, i, "(", ")")
            if j < 0:
                errors, j = errors + 1, i
            head += code[i : j + 1]
            i = j + 1
            continue
        else:
            head.append(code[i])
        i += 1
    errors += len(scopes)
    for e in out:
        yield (*e, errors)
    if not out:
        yield (*[None] * 10, errors)


def _declared(text: str, head: list[re.Match]) -> str | None:
    """The name of the function that a head before a semicolon declares."""
    words = [m.group() for m in head]
    if "(" not in words or words[0] in ("using", "typedef", "return", "friend", "static_assert", "class", "struct", "enum", "union") or "=" in words[: words.index("(")]:
        return None
    at = words.index("(")
    kind, name = _entity([w for w in words if not w.startswith('"')])
    if kind != "Function" or at < 2 and not name.startswith(("operator", "~")) or re.match(r"\s*[\d\"'{]", text[head[at].end() :][:40]):
        return None  # a call of a macro, or a variable with its value
    return name


def _entity(words: list[str]) -> tuple[str | None, str | None]:
    """Type and name that a head before a body declares."""
    for k, w in enumerate(words):
        if w in ("class", "struct") and "(" not in words[:k] and words[k - 1 : k] != ["enum"]:
            stop = next((j for j in range(k, len(words)) if words[j] == ":"), len(words))
            names = words[k + 1 : stop]
            if "(" in names and not (len(names) > 1 and names[1] == "("):
                break
            while "(" in names:  # a macro with arguments
                a = names.index("(")
                b = names.index(")", a)
                names = names[: max(0, a - 1)] + names[b + 1 :]
            if "final" in names:
                names = names[: names.index("final")]
            joined = re.sub(r"\s*::\s*", "::", " ".join(names))
            last = re.search(r"([\w:~]+(?:\s*<.*>)?)$", joined)
            return ("Class" if w == "class" else "Struct"), re.sub(r"\s*([<>,])\s*", r"\1", last.group(1)) if last else None
        if w in ("enum", "union"):
            return None, None
    if "operator" in words:
        k = words.index("operator")
        rest = words[k + 1 :]
        a = 2 if rest[:2] == ["(", ")"] else rest.index("(") if "(" in rest else 0
        return ("Function", "operator" + "".join(rest[:a])) if a else (None, None)
    if "(" not in words or "=" in words[: words.index("(")]:
        return None, None
    a = words.index("(")
    k = a
    while k >= 2 and words[k - 2] == "::":
        k -= 2
    name = "".join(words[k - 1 : a]) if a else ""
    return ("Function", name) if re.fullmatch(r"(?:~?\w+::)*~?\w+", name) and name not in ("if", "for", "while", "switch", "catch") else (None, None)


def discover(spark: SparkSession, root: str, repo: str) -> DataFrame:
    """(repo, file_path, content) of the C++ files under ``root``, hidden and build directories left out at any depth."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), "^" + re.escape(root.rstrip("/")).replace("\\-", "-") + "/", "")
    names = "|".join(re.escape(x) for x in SKIPPED)
    ends = "|".join(re.escape(x) for x in EXTENSIONS)
    ok = path.rlike(f"(?:{ends})$") & ~path.rlike(rf"(?:^|/)(?:\.[^/]*|{names})/")
    return files.where(ok).select(F.lit(repo).alias("repo"), path.alias("file_path"), "content")


def read_file(spark: SparkSession, path: str, repo: str, root: str | None = None) -> DataFrame:
    """One C++ file as (repo, file_path, content), its path relative to ``root`` or to its own folder."""
    if not path.endswith(EXTENSIONS):
        raise ValueError(f"{path} is no C++ file, whose name ends in one of {', '.join(EXTENSIONS)}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)
    folder = (root or path.rpartition("/")[0]).rstrip("/") + "/"
    return spark.read.format("binaryFile").load(path).select(F.lit(repo).alias("repo"), F.lit(path.removeprefix(folder)).alias("file_path"), "content")


def _scanned(files: DataFrame) -> DataFrame:
    def run(frames):
        for pdf in frames:
            rows = []
            for repo, path, content in zip(pdf["repo"], pdf["file_path"], pdf["content"]):
                body = bytes(content or b"").decode("utf-8", "replace").removeprefix("\ufeff").replace("\r\n", "\n")
                rows += [(repo, path, *r) for r in scan(body)]
            yield pd.DataFrame(rows, columns=["repo_name", "file_path", *[c.split()[0] for c in RAW.split(", ")]])

    is_cpp = F.col("file_path").rlike("(?:" + "|".join(re.escape(x) for x in EXTENSIONS) + ")$")
    return spread(files.where(is_cpp).select("repo", "file_path", "content")).mapInPandas(run, f"repo_name string, file_path string, {RAW}")


def _taken(include_declarations: bool, extern_c_declarations: bool):
    """Definitions, and declarations if all are wanted, or those in extern "C" if these are."""
    declared = F.col("is_declaration")
    return F.col("entity_type").isNotNull() & (~declared | F.lit(include_declarations) | (F.col("extern_c") & F.lit(extern_c_declarations)))


def entities(files: DataFrame, include_declarations: bool = False, extern_c_declarations: bool = False) -> DataFrame:
    """Entity rows, with ``parse_errors`` of their file, from (repo, file_path, content); files without any give none."""
    raw = _scanned(files).where(_taken(include_declarations, extern_c_declarations))
    sig = F.when(F.col("entity_type") == "Function", signature_hash(signature_source(F.col("code_text"))))
    doc = clean_doxygen(F.col("comment"))
    e = raw.withColumns({"entity_name": cpp_name("entity_name"), "function_sig_hash": sig, "docstring": F.when(doc != "", doc)})
    e = e.withColumn("global_uri", global_uri("repo_name", "file_path", "entity_type", "entity_name"))
    return salted_overloads(e, "position").select(
        "global_uri", "repo_name", "file_path", "entity_type", "entity_name", "docstring", "code_text", "start_line", "end_line", "is_templated", "function_sig_hash", F.col("errors").alias("parse_errors")
    )


def diagnostics(files: DataFrame, include_declarations: bool = False, extern_c_declarations: bool = False) -> DataFrame:
    """(repo_name, file_path, parse_error_count, entity_count) of every C++ file, also of those without entities."""
    rows = _scanned(files).groupBy("repo_name", "file_path")
    return rows.agg(F.max("errors").alias("parse_error_count"), F.count_if(_taken(include_declarations, extern_c_declarations)).alias("entity_count"))


def numbered_files(files: DataFrame) -> DataFrame:
    """``files`` with ``seq``, their place by path in their repository, for rules by which the first or last file wins."""
    w = Window.partitionBy("repo").orderBy("file_path")
    return files.withColumn("seq", F.row_number().over(w) - 1)


def salted_overloads(df: DataFrame, order: str) -> DataFrame:
    """Repeats of a signature hash within one file, type and name get a hash of their own; the first keeps it."""
    w = Window.partitionBy("repo_name", "file_path", "entity_type", "entity_name", "function_sig_hash").orderBy(order)
    n = F.row_number().over(w) - 1
    again = F.col("function_sig_hash").isNotNull() & (n > 0)
    return df.withColumn("function_sig_hash", F.when(again, signature_hash(F.concat("function_sig_hash", F.lit("|duplicate:"), n.cast("string")))).otherwise(F.col("function_sig_hash")))
