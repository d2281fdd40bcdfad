import json

from lodestrand.plans.report import observed, rates, status, write_report
from lodestrand.sources.compdb import common_anchor, foreign_toolchain, localise, project_root, read_compdb


def test_localise(spark, tmp_path):
    rows = [
        {"directory": "C:\\work\\proj\\out", "file": "C:\\work\\Proj\\src\\a.cpp", "arguments": ["cl.exe", "/c"]},
        {"directory": "C:\\work\\proj", "file": "c:/WORK/proj/extra/src/b.cpp", "command": "\"C:\\x\\cl.exe\" /c b.cpp"},
        {"directory": "/p", "file": "src/c.cpp", "command": "g++ -c c.cpp"},
        {"directory": "/p", "file": "src/missing.cpp", "command": "g++ -c x.cpp"},
    ]
    path = tmp_path / "compile_commands.json"
    path.write_text(json.dumps(rows, indent=1))
    e = read_compdb(spark, str(path))
    assert [x.lower() for x in common_anchor(e, "file")] == ["c:", "work"]
    files = spark.createDataFrame([("/p/Proj/src/a.cpp",), ("/p/extra/src/b.cpp",), ("/p/src/c.cpp",)], "path string")
    assert sorted(r["file"] for r in localise(e, files, "/p").collect()) == ["/p/Proj/src/a.cpp", "/p/extra/src/b.cpp", "/p/src/c.cpp"]
    assert foreign_toolchain(e, least=2, share=0.5) and not foreign_toolchain(e)
    assert localise(e.limit(0), files, "/p").count() == 0


def test_reports(spark, tmp_path):
    df, seen = observed(spark.createDataFrame([(1, None), (2, "bad"), (3, None)], "id int, reason string"), "reason")
    df.collect()
    body = rates(seen.get["attempted"], seen.get["dropped"])
    assert body == {"attempted": 3, "dropped": 1, "uploaded": 2, "success_rate": 0.666667}
    assert rates(0, 0)["success_rate"] == 1.0
    write_report(str(tmp_path / "r.json"), body, "run-1")
    kept = json.loads((tmp_path / "r.json").read_text())
    assert kept["run_id"] == "run-1" and list(kept) == sorted(kept)
    assert [status(0, 2), status(1, 1), status(2, 0)] == ["success", "partial_success", "failed"]


def test_project_root():
    assert project_root("/x/p/build/compile_commands.json") == "/x/p" and project_root("/x/p/compile_commands.json") == "/x/p"
