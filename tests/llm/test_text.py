import datetime
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lodestrand.llm import origin
from lodestrand.llm.funcdocs import described_functions, documented_functions, function_docs, trivial
from lodestrand.llm.mojibake import SWAPS, Restorer, restored_documents
from lodestrand.llm.neardup import duplicate_groups, similar_classes, similar_pairs
from lodestrand.llm.origin import file_origins
from lodestrand.llm.repair import grammars

CLASS = """class API A : public B {
 public:
  A() = default;
  /** Drops entries older than the given mark. */
  [[nodiscard]]
  int drop(int mark) noexcept { return "}" ? 1 : 2; }
  /// Keeps at most one entry per key.

  int apart() { return 1; }
  //! Only declared, never given a body here.
  int declared(int x);
  int x = 0;  ///< a note behind code about nothing at all
  int after() { return 1; }
  // plain words that are no documentation
  template <typename T>
  int plain(T t) { for (;;) { if (t) { break; } } return 0; }
  /*! Returns the sum of both
      numbers given to it. */
  template <typename T> T operator+(const T& o) const { return o; }
};"""


def test_methods_and_comments():
    got = {n: c for n, _, c in documented_functions(CLASS)}
    assert set(got) == {"drop", "apart", "after", "plain", "operator+"}
    assert got["drop"].startswith("/** Drops") and got["operator+"].startswith("/*!")
    assert got["apart"] == got["after"] == got["plain"] == ""


@pytest.mark.parametrize("doc", ["", "TODO", "@param a\n@param b\n@return", "====", "Parse node.", "Parses the node.", "See header.", "@copydoc Other", "XXX needs documentation, ask the owner", "Copyright (c) the authors. All rights reserved.", "if (a) { b(c); }\nreturn x;", "Method description goes here.", "计算权重"])
def test_trivial(doc):
    assert trivial(doc, "ParseNode")


@pytest.mark.parametrize("doc", ["Drops entries older than the mark.", "@brief Fails when no page is left.", "计算当前窗口内所有节点的权重。", "Entfernt veraltete Knoten aus dem Puffer."])
def test_not_trivial(doc):
    assert not trivial(doc, "ParseNode")


def entities(spark, rows):
    day = datetime.datetime(2025, 1, 1)
    full = [(*r, day + datetime.timedelta(i), "extra") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "entity_id long, entity_type string, entity_name string, docstring string, code_text string, ingested_at timestamp, function_name string")


def test_function_docs(spark):
    rows = [(1, "Function", "n::f", "Drops entries older than the mark.", "int f() { return 1; }"), (1, "Function", "n::f", None, "int f() { return 1; }"), (2, "Function", "g", None, "/// Keeps at most one entry per key.\nint g() { return 1; }"), (3, "Function", "h", "Says a lot about nothing here.", "int h();"), (4, "Class", "A", None, CLASS), (5, None, None, None, None), (6, "Function", "q", "x", ""), (None, "Function", "z", "Words that say something here.", "int z() {}")]
    got = {(r["entity_id"], r["function_name"]) for r in described_functions(entities(spark, rows)).collect()}
    assert got == {(2, "g"), (4, "drop"), (4, "operator+")}
    assert function_docs(entities(spark, rows)).count() == 7
    assert described_functions(entities(spark, rows).limit(0)).count() == 0


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(4)
    base = [[f"w{r.randrange(400)}" for _ in range(r.randrange(30, 90))] for _ in range(25)]
    texts = []
    for b in base:
        for _ in range(4):
            t = list(b)
            for _ in range(r.randrange(0, 6)):
                t[r.randrange(len(t))] = f"n{r.randrange(10**6)}"
            texts.append(" ".join(t))
    texts += ["", "one two three", texts[0], texts[0], " ".join(["same"] * 3000)] + [" ".join(f"c{i % 50}" for i in range(200))] * 30
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(9999, None, 0)]
    df = spark.createDataFrame(rows, "id long, text string, shingles int")

    def grams(t):
        w = t.split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 30 else set()

    g = [grams(t) for t in texts]
    want = {(i, j) for i in range(len(g)) for j in range(i + 1, len(g)) if g[i] and g[j] and len(g[i] & g[j]) >= 0.6 * len(g[i] | g[j])}
    pairs = similar_pairs(df, "id", "text", 0.6, 3, 30)
    assert {(r["a"], r["b"]) for r in pairs.collect()} == want
    groups = {r["id"]: (r["class_id"], r["group_id"], r["links"]) for r in duplicate_groups(*similar_classes(df, "id", "text", 0.6, 3, 30)).collect()}
    first = len(texts) - 30
    assert groups[first + 5] == (first, first, 29) and len(groups) == len({x for p in want for x in p})
    links = {}
    for i, j in want:
        links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
    assert {i: x[2] for i, x in groups.items()} == links
    assert similar_pairs(df.limit(0), "id", "text").count() == 0
    assert duplicate_groups(*similar_classes(df.limit(0), "id", "text")).count() == 0


def test_near_duplicates_that_share_hot_shingles(spark):
    r = random.Random(6)
    common = [f"licence{i}" for i in range(30)]
    texts = [" ".join(common + [f"t{i // 2}x{k}" for k in range(12)] + ([f"n{i}"] if i % 2 else [])) for i in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {(x["a"], x["b"]) for x in similar_pairs(df, "id", "text", 0.85, 2, hot_rows=16).collect()}
    assert got == {(i, i + 1) for i in range(0, 400, 2)}
    same = spark.createDataFrame([(i, "a b c d e f g " * (1 + i % 2)) for i in range(3000)], "id int, text string")
    groups = duplicate_groups(*similar_classes(same, "id", "text", 0.7, 2)).groupBy("class_id", "group_id", "links").count().collect()
    assert sorted(map(tuple, groups)) == [(0, 0, 2999, 1500), (1, 0, 2999, 1500)] and r


def test_origins(spark):
    r = random.Random(5)
    field = "  int Get{0}() const {{ return {0}_; }}\n  void Set{0}(const int& v) {{ {0}_ = v; bits_ |= 0x{1}; }}\n  int {0}_ = {{}};\n"
    generated = "class A final {\n public:\n" + "".join(field.format(f"f{i}", i) for i in range(30)) + "};\n"
    banner = "// Code generated by tool. DO NOT EDIT.\nint x;\n"
    speaks = 'void f() {\n  out << "// Code generated by tool. DO NOT EDIT.\\n";\n}\n// The ids below are generated by the service at run time.\n'
    blob = "const unsigned char k[] = {\n" + ",\n".join(", ".join(str(r.randrange(256)) for _ in range(16)) for _ in range(40)) + "};\n"
    mini = "".join(f"function f{i}(a,b){{return a.x?b:a+{i}}}" for i in range(60))
    vendored = "/* Bundled copy of lib 1.2.3, imported unchanged from upstream revision abc */\nint y;\n"
    rows = [(1, "a", "src/a.h", generated), (2, "a", "src/b.h", banner), (3, "a", "src/c.cc", speaks), (4, "a", "src/d.c", blob), (5, "a", "web/e.js", mini), (6, "a", "src/util/f.h", vendored), (7, "a", "third_party/lib/g.h", "int z;"), (8, "a", "src/vendor_api/h.h", "int z;"), (9, "a", "x.cc", ""), (10, None, None, None), (11, "b", "data.cc", "id,name\n" + "".join(f"{i},n{i}\n" for i in range(60)))]
    rows += [(12, "b", "src/m.h", banner.replace("int x", "char c")), (13, "b", "src/util/n.h", vendored.replace("1.2.3", "1.2.4").replace("int y", "long q")), (14, "b", "third_party/lib/o.h", "int zz;"), (15, "b", "notes.h", "# Notes\n" + "".join(f"- fold the page {i} now\n" for i in range(40)))]
    rows += [(16, "a", "src/p.h", "// Copyright (c) the project authors. All rights reserved.\nint p;\n"), (17, "b", "src/q.h", "// Copyright (c) the project authors. All rights reserved.\nint q;\n")]
    df = spark.createDataFrame([(a, b, c, d.encode() if d is not None else None, "x") for a, b, c, d in rows], "file_id int, repo string, file_path string, content binary, origin string").coalesce(1)
    got = {x["file_id"]: x["origin"] for x in file_origins(df).collect()}
    assert got == {1: "generated", 2: "generated", 3: "handwritten", 4: "blob", 5: "minified", 6: "vendored", 7: "vendored", 8: "handwritten", 9: "handwritten", 10: "handwritten", 11: "blob", 12: "generated", 13: "vendored", 14: "vendored", 15: "handwritten", 16: "handwritten", 17: "handwritten"}
    assert file_origins(df.limit(0)).count() == 0


def test_banners_behind_long_headers(spark):
    licence = "/*\n" + " * Permission is granted to anyone to use this software for any purpose.\n" * 40 + " */\n"
    lines = "".join(f"// line {i} of the terms\n" for i in range(12))
    banner = "// Bundled copy of zipper 1.2.3, imported unchanged from upstream\n"
    body = "int f() { return 1; }\n"
    later = "#include <a>\n" + body + "// plain\n" * 6 + banner
    # w.cc lies in a folder named like the library that two repositories name.
    texts = [("a", "src/x.cc", licence + banner + body), ("a", "src/y.h", "#ifndef Y_H\n#define Y_H\n" + lines + banner + body), ("b", "src/z.py", lines.replace("//", "#") + banner.replace("//", "#") + "x = 1\n"), ("b", "src/zipper/w.cc", body), ("c", "src/v.cc", later)]
    df = spark.createDataFrame([(i, r, p, t.encode()) for i, (r, p, t) in enumerate(texts)], "file_id int, repo string, file_path string, content binary").coalesce(1)
    got = {x["file_id"]: x["origin"] for x in file_origins(df).collect()}
    assert got == {0: "vendored", 1: "vendored", 2: "vendored", 3: "vendored", 4: "handwritten"}


def test_verbatim_copies_without_marks(spark):
    r = random.Random(9)

    def library(seed):
        w = random.Random(seed)
        name = lambda: f"n{w.randrange(10**6)}"
        forms = ["int {0}({1} a) {{ return a.{2} + {3}; }}", "struct {0} : {1} {{ {2} x; }};", "using {0} = {1}<{2}>;", "static {0} {1} = {2}({3}, 7);", "enum {0} {{ {1}, {2} }};"]
        return "\n".join(w.choice(forms).format(name(), name(), name(), name()) for _ in range(40))

    mine = "".join(f"int only{i}() {{ return {r.randrange(10**6)}; }}\n" for i in range(30))
    rows = [(i, repo, f"src/{repo}{i}.cc", library(1)) for i, repo in enumerate("abc")] + [(3, "a", "src/mine.cc", mine), (4, "a", "x.cc", library(2)), (5, "b", "y.cc", library(2)), (6, "d", "z.cc", library(1)[:1200] + mine)]
    rows += [(i, repo, f"{repo}/{i}.h", "int x;\n") for i, repo in enumerate("abcd", 7)]
    df = spark.createDataFrame([(a, b, c, d.encode()) for a, b, c, d in rows], "file_id int, repo string, file_path string, content binary")
    got = {x["file_id"]: (x["origin"], x["shared_share"]) for x in file_origins(df).collect()}
    assert {k for k, v in got.items() if v[0] == "vendored"} == {0, 1, 2}
    assert got[0][1] == 1 and 0 < got[6][1] < 0.8 and got[4][1] == got[5][1] == 0  # two repositories are too few


def test_origins_read_tokens_once(monkeypatch):
    r = random.Random(4)
    lines = ["id, name, 7", "- fold ½ ² the page", "key: value 3", "x = y1 + 0x1F;", "if None", "a\x0bb, 2", "ключ, ٣", "", "s = 'one two' \"a\\\"b\""]
    texts = ["\n".join(r.choice(lines) for _ in range(r.randrange(30))) for _ in range(300)]
    found, sorted_keys = [], []

    class Counted:
        def __init__(self, pattern):
            self.pattern = pattern

        def findall(self, text):
            found.append(len(text))
            return self.pattern.findall(text)

    unique = np.unique
    monkeypatch.setattr(origin, "_TOKEN", Counted(origin._TOKEN))
    monkeypatch.setattr(np, "unique", lambda x, *a, **k: sorted_keys.append(len(x)) or unique(x, *a, **k))
    batch = pa.record_batch({"file_id": pa.array(range(300)), "repo": ["a"] * 300, "file_path": ["x.cc"] * 300, "content": [x.encode() for x in texts], "language": ["C++"] * 300})
    out = pa.Table.from_batches(origin._features(24, 12, 4)(iter([batch]))).to_pylist()
    assert sum(found) <= sum(map(len, texts))  # each text's code is cut into tokens once
    sorted_keys.clear()
    grammars(np.arange(10_000, dtype="u8") * np.uint64(0x9E3779B97F4A7C15), np.zeros(10_000, "i8"))
    assert sum(sorted_keys) < 5_000  # pairs that can occur but once are not sorted
    for text, row in zip(texts, out):  # the literals and their share, line by line
        code, _, strings = origin._split(text, False)
        n, share, other = sum(len(re.findall(r"\w{1,3}|[^\w\s]", x)) for x in strings), sum(map(len, strings)), 0
        for line in code.split("\n"):
            data = not re.search(r"[;{}()=<>\\&|!?@]", line) and origin._RECORD.fullmatch(line)
            for t in re.findall(r"\w+|[^\w\s]", line):
                if t[0].isdigit() or data and (t[0].isalpha() or t[0] == "_") and t not in origin._WORDS:
                    n, share = n + 1, share + len(t)
                elif t not in ",[]:-.":
                    other += len(t)
        assert (row["literals"], row["literal_share"]) == (n, share / max(1, share + other))


def test_every_swap_can_be_undone():
    r = Restorer()
    for k, (read, written) in enumerate(SWAPS):
        for word in ("naïve", "façade", "Größe", "żółw", "проверьте", "узел", "图中的节点", "ノード"):
            try:
                garbled = word.encode(written).decode(read)
            except UnicodeError:
                continue
            if garbled != word:
                assert r.undo(garbled, k) == word


def test_restore(spark):
    words = "naïve façade Größe Änderungen проверьте пожалуйста узел удаляется вместе с рёбрами была отклонена".split()
    clean = [(i, " ".join(words), "s") for i in range(60)]
    bad = [(100, "Die " + "Änderungen".encode().decode("cp1252") + " hier", "s"), (101, "проверьте пожалуйста".encode("cp1251").decode("cp1252"), "s"), (102, "lost � here", None), (103, "turns `é` into `Ã©` and `�` too", "s"), (104, None, None), (105, "", "s"), (106, "naïve".encode().decode("cp1252").encode().decode("cp1252"), "S ")]
    df = spark.createDataFrame([(a, b, c, 1) for a, b, c in clean + bad], "doc_id int, text string, source string, words int")
    got = {r["doc_id"]: r for r in restored_documents(df).collect()}
    assert {k for k, r in got.items() if r["garbled"]} == {100, 101, 102, 106}
    assert got[100]["restored"] == "Die Änderungen hier" and got[101]["restored"] == "проверьте пожалуйста" and got[106]["restored"] == "naïve"
    assert restored_documents(df.limit(0)).count() == 0


def test_restore_other_scripts_and_stretches(spark):
    def bad(x):
        return x.encode().decode("cp1252", "surrogateescape").translate({0xDC00 + b: b for b in range(128, 256)})

    clean = "The naïve façade of the Größe is “quoted” here, проверьте узел 图中的节点已经删除".split()
    rows = [(i, " ".join(clean), "s") for i in range(60)]
    whole = ["삭제되었습니다", "العقدة", "הצומת", "ลบแล้ว", "được", "🧪🧪", "✅", "⭐", "\ufeffThe"]
    rows += [(100 + i, f"the {bad(x)} here", "s") for i, x in enumerate(whole)]
    rows += [(200, f"the “{bad('façade')}” here", "s"), (201, f"图中的{bad('façade')}节点已经删除", "s"), (202, "the " + bad("проверьте")[:-1] + " here", "s")]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = {r["doc_id"]: r for r in restored_documents(df).collect()}
    assert {k for k, r in got.items() if r["garbled"]} == {r[0] for r in rows[60:]}
    assert {k: got[k]["restored"] for k in got if 100 <= k < 200} == {100 + i: f"the {x} here" for i, x in enumerate(whole)}
    assert got[200]["restored"] == "the “façade” here" and got[201]["restored"] == "图中的façade节点已经删除" and "проверьт" in got[202]["restored"]


_RUSSIAN = """после обновления индекс больше содержит символов проверьте пожалуйста узел удаляется вместе рёбрами была отклонена потому что сборка падает при чтении файла строка таблица
ошибка возникает только если очередь пуста значение поля меняется без блокировки поток ждёт события память освобождается слишком поздно запрос возвращает старые данные нужно добавить
тест который показывает проблему функция вызывается дважды результат зависит порядка аргументов сервер закрывает соединение раньше времени клиент получает пустой ответ документ описывает
новый формат журнала изменения вступят силу следующей версии поэтому лучше подождать выпуска исправления""".split()


def test_cipher_of_no_known_page(spark):
    r = random.Random(3)
    sentences = [" ".join(r.choice(_RUSSIAN) for _ in range(9)) for _ in range(480)]
    letters = sorted({c for w in _RUSSIAN for c in w})
    signs = [chr(c) for c in range(0xC0, 0x100)]
    r.shuffle(signs)
    cipher = dict(zip(map(ord, letters), signs))
    rows = [(i, s, f"good{i % 3}") for i, s in enumerate(sentences[:400])] + [(1000 + i, s.translate(cipher), "bad") for i, s in enumerate(sentences[400:])]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    right = {}
    for rounds in (0, 3):
        got = {x["doc_id"]: x for x in restored_documents(df, rounds=rounds).collect()}
        assert not any(x["garbled"] for k, x in got.items() if k < 1000)
        words = [(a, b) for i, s in enumerate(sentences[400:]) for a, b in zip(got[1000 + i]["restored"].split(), s.split())]
        right[rounds] = sum(a == b for a, b in words) / len(words)
    assert right[0] < 0.1 and right[3] > 0.7


def test_shares_back_off_to_the_corpus(spark):
    good = "Änderungen naïve façade Größe Übersicht Löschung geprüft später können müssen".split()
    bad = lambda w: w.encode().decode("cp1252")
    rows = [(i, " ".join(good), f"s{i % 4}") for i in range(80)] + [(100 + i, " ".join(map(bad, good[:6])), f"s{i % 4}") for i in range(8)] + [(200, "die " + bad("Änderungen"), "tiny"), (201, "die Änderungen", "tiny")]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = {x["doc_id"]: x for x in restored_documents(df).collect()}
    assert {k for k, x in got.items() if x["garbled"]} == {*range(100, 108), 200} and got[200]["restored"] == "die Änderungen"
