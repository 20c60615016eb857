"""Static dependency extraction from setup files.

Finding the literal lists in a Python file needs Python's own grammar, so this
is the one place with a Python function: a small helper inside an
Arrow-batched UDF.  Names are normalised, sorted and counted by Spark.
"""

from __future__ import annotations

import ast
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from commonspulse.functions.expressions import package_name, stripped

# Executors get the helper functions with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _SetupCalls(ast.NodeVisitor):
    """Gathers what ``install_requires`` is given in calls named ``setup``, plain or as an attribute."""

    def __init__(self, constants: dict[str, list[str]]) -> None:
        self.constants, self.texts = constants, []

    def visit_Call(self, node: ast.Call) -> None:
        match node.func:
            case ast.Name(id="setup") | ast.Attribute(attr="setup"):
                for keyword in node.keywords:
                    match keyword:
                        case ast.keyword(arg="install_requires", value=ast.Name(id=name)):
                            self.texts.extend(self.constants.get(name, ()))
                        case ast.keyword(arg="install_requires", value=value):
                            self.texts.extend(string_literals(value) or ())
        self.generic_visit(node)


def string_literals(node: ast.AST | None) -> list[str] | None:
    """The texts of a written-out list, tuple or set that holds nothing but texts."""
    match node:
        case ast.List(elts=parts) | ast.Tuple(elts=parts) | ast.Set(elts=parts):
            if all(isinstance(p, ast.Constant) and isinstance(p.value, str) for p in parts):
                return [ast.literal_eval(p) for p in parts]
    return None


def module_constants(module: ast.Module) -> dict[str, list[str]]:
    """Names that the module's own statements bind to written-out texts; the last such binding counts."""
    pairs = []
    for statement in module.body:
        match statement:
            case ast.Assign(targets=targets, value=value):
                pairs += [(target, value) for target in targets]
            case ast.AnnAssign(target=target, value=value):
                pairs.append((target, value))
    return {t.id: texts for t, v in pairs if isinstance(t, ast.Name) and (texts := string_literals(v)) is not None}


def literal_requirements(source: str | None) -> list[str]:
    """Requirement texts of every ``setup(install_requires=...)`` call, never executing code."""
    try:
        module = ast.parse(source or "")
        calls = _SetupCalls(module_constants(module))
        calls.visit(module)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []
    return calls.texts


@F.pandas_udf(ArrayType(StringType()))
def _requirement_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for sources in batches:
        yield sources.map(literal_requirements)


def parsed_dependencies(files: DataFrame) -> DataFrame:
    """``(repo_id, source)`` to ``(repo_id, dependencies)``, sorted and distinct per file."""
    texts = files.select("*", _requirement_texts("source").alias("_texts")).drop("source")
    pairs = F.transform(
        "_texts",
        lambda t: F.struct(package_name(t).alias("package_name"), stripped(t).alias("requirement")),
    )
    named = F.filter(pairs, lambda p: p["package_name"] != "")
    return texts.withColumn("dependencies", F.array_sort(F.array_distinct(named))).drop("_texts")


def setup_dependencies(files: DataFrame) -> DataFrame:
    """``(repo_id, source)`` to one row per package and requirement."""
    return parsed_dependencies(files).select("repo_id", F.inline("dependencies"))


def dependency_counts(files: DataFrame) -> DataFrame:
    return parsed_dependencies(files).select("repo_id", F.size("dependencies").alias("dependency_count"))
