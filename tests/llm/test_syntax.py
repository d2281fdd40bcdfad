import ast
import random

import pytest

from lodestrand.llm.syntax import acceptance, check_cpp, check_javascript, check_python, faults, parsed_files

GOOD_CPP = r"""
#ifndef A_H
#define A_H
#include <vector>
template <typename T, int N = 3> class Foo : public Bar<T>, private virtual Baz {
 public:
  explicit Foo(int a, std::string b = "x") : a_(a), b_{b} {}
  ~Foo() override = default;
  Foo& operator=(const Foo& o) noexcept { if (this == &o) return *this; return *this; }
  bool operator()(int x) const { return x < a_ && x > 3; }
  static constexpr int kMax = 1'000'000;
  using It = typename std::vector<T>::iterator;
  int (*fp)(int, char) = nullptr;
  unsigned flags : 3;
  enum class E : int { A, B = 2, C };
 private:
  T a_; std::map<std::string, std::vector<int>> m_;
};
#endif
namespace a::b { inline namespace c { extern "C" { void f(void); int g(int a[], ...); } } }
auto f(int x) -> std::vector<int> { return {1, 2, x}; }
int main(int argc, char** argv) {
  for (auto& [k, v] : m) { std::cout << k << "a" "b" << std::endl; }
  auto l = [&, this](auto&& x) mutable -> int { return x ? 1 : 2; };
  int a = (int)b, *p = new int[10], c{3};
  do { --a; } while (a > 0);
  switch (a) { case 1: case 'c': break; default: return 1; }
  try { throw std::runtime_error("x"); } catch (const std::exception& e) { } catch (...) { throw; }
  if (auto it = m.find(3); it != m.end()) { } else if (x < y) ;
  return R"(hello "world)" ? static_cast<int>(y) + sizeof(int) : 0;
}
Foo::Foo() : x(1) { }
MACRO_CALL(x, y)
"""


@pytest.mark.parametrize("code", [GOOD_CPP, "", "\n// only a comment\n", "#pragma once\n", "class API_EXPORT A;", "#if A\nint f(int a) {\n#else\nint f(long a) {\n#endif\n  return a;\n}\n"])
def test_valid_cpp(code):
    assert check_cpp(code) == []


@pytest.mark.parametrize(
    "code",
    ["int f( { }", "int f() { return 1 }", "class A { int x; }", "int f() { a b c; }", "int f() {", "}", "int x = ;", "def f(x):\n  return 1\n", "# Notes\n\n- a b\n", '{"a": 1}', "int f() {\n<<<<<<< HEAD\n a();\n=======\n b();\n>>>>>>> x\n}", "a,b,c\n1,2,3", '"abc', "/* x", "#if A\nint x;\n", "#if A\n}\n#endif", "for x in y; do echo; done", "int f() { foo(a,); }", "int f() { else { } }", "struct A { int x int y; };"],
)
def test_invalid_cpp(code):
    assert check_cpp(code)


def test_all_errors_come_out():
    assert len(check_cpp("int f() { a b c; return 1; }\nint g() { x + ; }\nint h() { return 2; }")) == 2


NESTED = ["#if A\n#elif B\n#else\n#ifdef C\nint ok;\n#else\nint = ;\n#endif\n#endif\n", "#if A\n#if B\n#elif C\n#if D\n#else\nint = ;\n#endif\n#endif\n#endif\n", "#if A\n#else\n#if B\nint = ;\n#endif\n#endif\n"]


@pytest.mark.parametrize("code", NESTED)
def test_branches_within_other_branches(code):
    assert check_cpp(code) and check_cpp(code.replace("int = ;", "int y;")) == []


def test_equal_conditions_are_switched_together():
    guard = '#ifdef __cplusplus\nextern "C" {\n#endif\nint f(void);\n#if defined( __cplusplus )  // end\n}\n#endif\n'
    assert check_cpp(guard) == []
    assert check_cpp("#ifndef A\nint f(int x) {\n#endif\n#ifdef A\nint f(long x) {\n#endif\nreturn 1; }\n") == []
    assert check_cpp(guard.replace("defined( __cplusplus )", "OTHER"))
    assert check_cpp("#ifdef A\nint f() {\n#endif\n#undef A\n#ifdef A\n}\n#endif\n")


def test_errors_of_all_variants_come_out_once():
    assert len(check_cpp("int = ;\n#if A\nint x = ;\n#else\nint f() { a b c; }\n#endif\nint g() { x + ; }\n")) == 4


def test_python_against_the_standard_parser():
    base = open(ast.__file__, encoding="utf-8").read()
    assert check_python(base) == []
    r = random.Random(1)
    lines = base.splitlines(keepends=True)
    for _ in range(120):
        a = r.randrange(len(lines) - 40)
        text = "".join(lines[a : a + 40])
        i = r.randrange(len(text))
        text = text[:i] + r.choice(["", ":", ")", "=", "]"]) + text[i + 1 :]
        try:
            ast.parse(text)
            ok = True
        except SyntaxError:
            ok = False
        if ok:
            assert check_python(text) == []


@pytest.mark.parametrize("code", ["let x = a => ({b: 1, ...c});", "const {a, b: [c]} = d ?? e?.f[0];", "for (const x of y) { if (/[{(]x/.test(x)) break }", "class A extends B { static #p = 1; get x() { return `a${b}c` } async *m() { yield 1 } }", "label: for (;;) { continue label }", "a\nb\n++c", "export default function () {}", "var f = async (x) => { await x }"])
def test_valid_javascript(code):
    assert check_javascript(code) == []


@pytest.mark.parametrize("code", ["let = = 1", "function f( { }", "a b", "if (x { }", "<<<<<<< HEAD\na()\n=======\nb()\n>>>>>>> x", "const x;", "{ a: 1, b: 2 }", "def f(x):\n  return 1", "`abc"])
def test_invalid_javascript(code):
    assert check_javascript(code)


def test_table(spark):
    rows = [(1, "r", "a.cc", b"int x;", None), (2, "r", "b.py", b"def f(:\n", 1), (3, "r", "c.txt", b"??", 1), (4, "r", None, b"", 1), (5, None, "d.js", None, 1), (5, None, "d.js", None, 1), (6, "r", "e.h", b"int \xff;", 2), (7, "r", "long.cpp", b"int x;\n" * 20000, 2), (8, "r", "deep.cpp", b"int x = " + b"(" * 5000 + b"1" + b")" * 5000 + b";", 2)]
    df = spark.createDataFrame(rows, "file_id int, repo string, file_path string, content binary, errors int")
    got = {r["file_id"]: r["n_errors"] for r in parsed_files(df).collect()}
    assert {k: v > 0 for k, v in got.items()} == {1: False, 2: True, 5: False, 6: True, 7: False, 8: False}
    rate = {(r["repo"], r["language"]): (r["files"], r["invalid"]) for r in acceptance(parsed_files(df)).collect()}
    assert rate == {("r", "C++"): (4, 1), ("r", "Python"): (1, 1), (None, "JavaScript"): (2, 0)}
    assert parsed_files(df.limit(0)).count() == 0


@pytest.mark.parametrize("check, text", [(check_cpp, "int x = " + "(" * 4000 + "1" + ")" * 4000 + ";"), (check_javascript, "x = " + "[" * 4000 + "]" * 4000), (check_python, "x = " + "(" * 150 + "1" + ")" * 150 + "\n")])
def test_deep_nesting_is_valid(check, text):
    lang = {check_cpp: "C++", check_javascript: "JavaScript", check_python: "Python"}[check]
    assert faults(text, lang) == [] and faults(text[:-3], lang)
