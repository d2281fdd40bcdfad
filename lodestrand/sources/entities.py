"""Entity rows as JSON lines, and manifests of repositories."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

ENTITY = (
    "global_uri string, repo_name string, file_path string, entity_type string, entity_name string, docstring string, code_text string,"
    " start_line int, end_line int, is_templated boolean, function_sig_hash string"
)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Blank lines are skipped; a malformed line fails the job."""
    return spark.read.schema(ENTITY).option("mode", "FAILFAST").json(path)


def write_entities(df: DataFrame, path: str) -> None:
    """One object for each line, nulls kept."""
    df.write.option("ignoreNullFields", "false").json(path)


@dataclass(frozen=True)
class Repository:
    name: str
    source_dir: str
    compdb: str | None = None


@dataclass(frozen=True)
class Manifest:
    repositories: list[Repository] = field(default_factory=list)


def read_manifest(path: str) -> Manifest:
    """A YAML or JSON manifest: ``repos``, each with a unique ``name`` and a ``source_dir``."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        import yaml

        data = yaml.safe_load(text)
    else:
        data = json.loads(text)
    if not isinstance(data, dict) or not isinstance(data.get("repos"), list):
        raise ValueError("a manifest needs a list of repos")
    out = []
    for r in data["repos"]:
        if not isinstance(r, dict) or not r.get("name") or not r.get("source_dir"):
            raise ValueError(f"a repository needs name and source_dir: {r}")
        out.append(Repository(r["name"], r["source_dir"], r.get("compdb")))
    if len({r.name for r in out}) != len(out):
        raise ValueError("repository names must be unique")
    return Manifest(out)
