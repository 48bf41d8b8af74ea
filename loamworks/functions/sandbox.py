"""A calculator without ``eval`` and graded code in a limited process (off unless asked for)."""

from __future__ import annotations

import ast
import operator
import resource
import subprocess
import sys
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_OPERATORS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv, ast.USub: operator.neg, ast.UAdd: operator.pos}
LONGEST = 400


def _value(node: ast.AST):
    if isinstance(node, ast.Expression):
        return _value(node.body)
    if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)) and not isinstance(node.value, bool):
        return node.value
    if isinstance(node, ast.BinOp) and type(node.op) in _OPERATORS:
        return _OPERATORS[type(node.op)](_value(node.left), _value(node.right))
    if isinstance(node, ast.UnaryOp) and type(node.op) in _OPERATORS:
        return _OPERATORS[type(node.op)](_value(node.operand))
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr == "count" and len(node.args) == 1 and not node.keywords:
        text, part = node.func.value, node.args[0]
        if all(isinstance(x, ast.Constant) and isinstance(x.value, str) for x in (text, part)):
            return text.value.count(part.value)
    raise ValueError("not a supported expression")


def calculate(expression: str | None) -> str | None:
    """Sums with ``+ - * / ()`` and ``'text'.count('part')``; null for anything else."""
    if expression is None or len(expression) > LONGEST or "**" in expression:
        return None
    try:
        return str(_value(ast.parse(expression.replace(",", "") if ".count(" not in expression else expression, mode="eval")))
    except (ValueError, SyntaxError, ZeroDivisionError, OverflowError, RecursionError, MemoryError):
        return None


def calculator(expression: Column) -> Column:
    @F.pandas_udf("string")
    def run(expressions: pd.Series) -> pd.Series:
        return expressions.map(calculate)

    return run(expression)


@dataclass
class Outcome:
    success: bool
    stdout: str
    stderr: str
    timeout: bool


def execute(code: str, seconds: float = 5.0, megabytes: int = 256, enabled: bool = False) -> Outcome:
    """Run code in its own interpreter with limits of time and memory; refuses unless ``enabled``."""
    if not enabled:
        raise PermissionError("running code is off; pass enabled=True")

    def limits() -> None:
        size = megabytes << 20
        resource.setrlimit(resource.RLIMIT_AS, (size, size))
        resource.setrlimit(resource.RLIMIT_CPU, (int(seconds) + 1, int(seconds) + 1))
        resource.setrlimit(resource.RLIMIT_FSIZE, (1 << 20, 1 << 20))

    try:
        done = subprocess.run([sys.executable, "-I", "-c", code], capture_output=True, text=True, timeout=seconds, preexec_fn=limits, stdin=subprocess.DEVNULL, env={})  # noqa: PLW1509
    except subprocess.TimeoutExpired:
        return Outcome(False, "", "", True)
    return Outcome(done.returncode == 0, done.stdout, done.stderr, False)


def grade_code(prompt_imports: str, program: str, test: str, entry: str, enabled: bool = False) -> bool:
    """Whether a program passes its test function."""
    return execute(f"{prompt_imports}\n\n{program}\n\n{test}\ncheck({entry})", enabled=enabled).success
