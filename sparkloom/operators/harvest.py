"""Functions harvested from Python sources, and programs made from a grammar."""

from __future__ import annotations

import ast
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_IMPURE = {"print", "input", "open", "exec", "eval", "globals", "setattr"}


def _functions(source: str) -> list[tuple]:
    """name, parameters, type returned, lines, pure, code of every top-level function; nothing where the source can't be parsed."""
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError, RecursionError):
        return []
    out = []
    for node in tree.body:
        if isinstance(node, ast.FunctionDef):
            inner = list(ast.walk(node))
            calls = {n.func.id for n in inner if isinstance(n, ast.Call) and isinstance(n.func, ast.Name)}
            pure = not calls & _IMPURE and not any(isinstance(n, (ast.Global, ast.Nonlocal, ast.Import, ast.ImportFrom, ast.Yield, ast.YieldFrom)) for n in inner)
            params = ",".join(a.arg + (":" + ast.unparse(a.annotation) if a.annotation else "") for a in node.args.args)
            returns = ast.unparse(node.returns) if node.returns else None
            out.append((node.name, params, returns, node.end_lineno - node.lineno + 1, pure, ast.get_source_segment(source, node)))
    return out


def python_functions(df: DataFrame, key: str, source: str) -> DataFrame:
    """key, place, name, params, returns, n_lines, pure, code of the top-level functions of Python sources.

    Null sources and those that can't be parsed have no rows; a function is pure if it calls nothing that reads, writes or
    runs code, imports nothing and has no state outside.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, i, *f) for k, s in zip(pdf[key], pdf[source]) if s is not None for i, f in enumerate(_functions(s))]
            yield pd.DataFrame(rows, columns=[key, "place", "name", "params", "returns", "n_lines", "pure", "code"])

    return df.where(F.col(source).isNotNull()).select(key, source).mapInPandas(run, f"{key} {kind}, place long, name string, params string, returns string, n_lines long, pure boolean, code string")


class _Dice:
    """Numbers that depend on a seed alone."""

    def __init__(self, seed: str):
        self.seed, self.n = seed, 0

    def roll(self, sides: int) -> int:
        self.n += 1
        return int.from_bytes(hashlib.sha256(f"{self.seed}:{self.n}".encode()).digest()[:8], "big") % sides


class Grammar:
    """Programs of the small language: every one has balanced braces, and names are bound before they are used."""

    def __init__(self, seed: str, depth: int = 3):
        self.dice, self.depth, self.names = _Dice(seed), depth, []

    def one(self, *choices):
        return choices[self.dice.roll(len(choices))]

    def value(self, depth: int = 2) -> str:
        if depth and self.dice.roll(3) == 0:
            return f"({self.value(depth - 1)}{self.one('+', '-', '*', '/')}{self.value(depth - 1)})"
        return self.one(*self.names) if self.names and self.dice.roll(2) else str(self.dice.roll(1000))

    def statement(self, depth: int) -> str:
        kind = self.dice.roll(4 if depth else 2)
        if kind == 0 or not self.names:
            v = self.value()
            self.names.append(f"v{len(self.names)}")
            return f"let {self.names[-1]}=mut.{v};"
        if kind == 1:
            return f"{self.one(*self.names)}={self.value()};"
        held = len(self.names)
        if kind == 2:
            test = f"{self.value(1)}{self.one('<', '>', '=')}{self.value(1)}"
            then = self.block(depth - 1)
            del self.names[held:]
            other = f"el{{{self.block(depth - 1)}}}" if self.dice.roll(2) else ""
            out = f"if({test}){{{then}}}{other};"
        else:
            i = f"v{held}"
            self.names.append(i)
            out = f"lp(let {i}=0;{i}<{self.dice.roll(100)};{i}={i}+1){{{self.block(depth - 1)}}};"
        del self.names[held:]
        return out

    def block(self, depth: int) -> str:
        return "".join(self.statement(depth) for _ in range(1 + self.dice.roll(3)))

    def program(self, name: str) -> str:
        parts = [f"M={name};"]
        for f in range(1 + self.dice.roll(3)):
            self.names = [f"p{k}" for k in range(self.dice.roll(3))]
            params = ";".join(f"{p}:i64" for p in self.names)
            parts.append(f"F=f{f}({params}):i64{{{self.block(self.depth)}<{self.value(1)}}};")
        return "".join(parts)


def grammar_programs(spark: SparkSession, count: int, seed: int, depth: int = 3) -> DataFrame:
    """i, source of `count` programs made from the grammar; a program depends on seed and i alone, so any cut of the range
    makes the same ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"i": pdf["id"], "source": [Grammar(f"{seed}:{i}", depth).program(f"fuzz{i}") for i in pdf["id"]]})

    return spark.range(count).mapInPandas(run, "i long, source string")
