"""Python functions as programs of the small language, as far as it has the same constructs."""

from __future__ import annotations

import ast
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Types and operators of both languages.
TYPES = {"int": "i64", "float": "f64", "bool": "bool", "str": "Str", "None": "void"}
ARITHMETIC = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*", ast.Div: "/", ast.FloorDiv: "/", ast.Mod: "%"}
METHODS = {"strip": "trim", "lower": "lower", "upper": "upper"}  # of text, in the module std.str
COMPARED = {ast.Eq: "{a}={b}", ast.NotEq: "!({a}={b})", ast.Lt: "{a}<{b}", ast.Gt: "{a}>{b}", ast.LtE: "!({a}>{b})", ast.GtE: "!({a}<{b})"}


class Unsupported(Exception):
    """A construct that the small language doesn't have; the message names it."""


class _Writer:
    """Writes one function; names that are bound get `let` the first time."""

    def __init__(self):
        self.bound: set[str] = set()
        self.loops = 0
        self.texts = False  # whether std.str is needed

    def type(self, node: ast.expr | None) -> str:
        if node is None:
            return "void"
        text = ast.unparse(node)
        if text in TYPES:
            return TYPES[text]
        if isinstance(node, ast.Subscript) and ast.unparse(node.value).lower() == "list":
            return f"[{self.type(node.slice)}]"
        raise Unsupported(f"type {text}")

    def value(self, node: ast.expr) -> str:
        match node:
            case ast.Constant(value=bool() as v):
                return str(v).lower()
            case ast.Constant(value=int() | float() as v):
                return repr(v)
            case ast.Constant(value=str() as v):
                return json.dumps(v, ensure_ascii=False)
            case ast.Name(id=name):
                return name
            case ast.BinOp(left=a, op=op, right=b) if type(op) in ARITHMETIC:
                return f"({self.value(a)}{ARITHMETIC[type(op)]}{self.value(b)})"
            case ast.UnaryOp(op=ast.USub(), operand=x):
                return f"(0-{self.value(x)})"
            case ast.UnaryOp(op=ast.Not(), operand=x):
                return f"!({self.value(x)})"
            case ast.Compare(left=a, ops=ops, comparators=rest) if all(type(o) in COMPARED for o in ops):
                sides = [self.value(x) for x in (a, *rest)]
                tests = [COMPARED[type(o)].format(a=x, b=y) for o, x, y in zip(ops, sides, sides[1:])]
                return tests[0] if len(tests) == 1 else "(" + "&".join(f"({t})" for t in tests) + ")"
            case ast.BoolOp(op=op, values=values):
                return "(" + ("&" if isinstance(op, ast.And) else "|").join(f"({self.value(v)})" for v in values) + ")"
            case ast.Call(func=ast.Name(id="len"), args=[x], keywords=[]):
                return f"{self.value(x)}.len"
            case ast.Call(func=ast.Name(id=name), args=args, keywords=[]) if name not in ("print", "range", "input"):
                return f"{name}({';'.join(map(self.value, args))})"
            case ast.Call(func=ast.Attribute(value=x, attr=name), args=[], keywords=[]) if name in METHODS:
                self.texts = True
                return f"str.{METHODS[name]}({self.value(x)})"
            case ast.Subscript(value=x, slice=ast.Slice(lower=low, upper=high, step=None)):
                self.texts, text = True, self.value(x)
                return f"str.slice({text};{self.value(low) if low else 0};{self.value(high) if high else text + '.len'})"
            case ast.Subscript(value=x, slice=i) if not isinstance(i, ast.Slice):
                return f"{self.value(x)}[{self.value(i)}]"
            case ast.List(elts=items):
                return f"[{';'.join(map(self.value, items))}]"
        raise Unsupported(f"expression {type(node).__name__}")

    def put(self, target: ast.expr, value: str) -> str:
        if isinstance(target, ast.Name):
            first = target.id not in self.bound
            self.bound.add(target.id)
            return f"let {target.id}=mut.{value};" if first else f"{target.id}={value};"
        if isinstance(target, ast.Subscript):
            return f"{self.value(target)}={value};"
        raise Unsupported(f"target {type(target).__name__}")

    def statement(self, node: ast.stmt) -> str:
        match node:
            case ast.Return(value=None):
                return "<0;"
            case ast.Return(value=x):
                return f"<{self.value(x)};"
            case ast.Assign(targets=[t], value=x):
                return self.put(t, self.value(x))
            case ast.AnnAssign(target=t, value=x) if x is not None:
                return self.put(t, self.value(x))
            case ast.AugAssign(target=t, op=op, value=x) if type(op) in ARITHMETIC:
                return f"{self.value(t)}={self.value(t)}{ARITHMETIC[type(op)]}{self.value(x)};"
            case ast.If(test=c, body=then, orelse=other):
                tail = f"el{{{self.block(other)}}}" if other else ""
                return f"if({self.value(c)}){{{self.block(then)}}}{tail};"
            case ast.While(test=c, body=body, orelse=[]):
                self.loops += 1
                w = f"w{self.loops}"
                return f"lp(let {w}=0;{self.value(c)};{w}=0){{{self.block(body)}}};"
            case ast.For(target=ast.Name(id=i), iter=ast.Call(func=ast.Name(id="range"), args=args, keywords=[]), body=body, orelse=[]):
                low, high, step = {1: ("0", 0, "1"), 2: (0, 1, "1"), 3: (0, 1, 2)}[len(args)]
                text = [x if isinstance(x, str) else self.value(args[x]) for x in (low, high, step)]
                self.bound.add(i)
                return f"lp(let {i}={text[0]};{i}<{text[1]};{i}={i}+{text[2]}){{{self.block(body)}}};"
            case ast.For(target=ast.Name(id=x), iter=ast.Name(id=items), body=body, orelse=[]):
                self.loops += 1
                i = f"i{self.loops}"
                self.bound.add(x)
                return f"lp(let {i}=0;{i}<{items}.len;{i}={i}+1){{let {x}={items}[{i}];{self.block(body)}}};"
            case ast.Break():
                return "br;"
            case ast.Pass():
                return ""
            case ast.Expr(value=ast.Constant(value=str())):
                return ""  # a docstring
            case ast.Expr(value=ast.Call() as call):
                return f"{self.value(call)};"
        raise Unsupported(f"statement {type(node).__name__}")

    def block(self, body: list[ast.stmt]) -> str:
        held = set(self.bound)
        out = "".join(map(self.statement, body)).rstrip(";")
        self.bound = held
        return out

    def function(self, node: ast.FunctionDef) -> str:
        if node.args.vararg or node.args.kwarg or node.args.kwonlyargs or node.args.defaults or node.decorator_list or any(a.annotation is None for a in node.args.args):
            raise Unsupported("parameters")
        self.bound = {a.arg for a in node.args.args}
        params = ";".join(f"{a.arg}:{self.type(a.annotation)}" for a in node.args.args)
        return f"F={node.name}({params}):{self.type(node.returns)}{{{self.block(node.body)}}};"


def transpiled(source: str, module: str) -> tuple[str | None, str | None]:
    """The program of a Python source that holds functions only, or why there is none."""
    try:
        tree = ast.parse(source)
        funcs = [n for n in tree.body if isinstance(n, ast.FunctionDef)]
        if not funcs or len(funcs) != len(tree.body):
            return None, "not functions only"
        writer = _Writer()
        body = "".join(map(writer.function, funcs))
        return f"M={module};" + ("I=str:std.str;" if writer.texts else "") + body, None
    except Unsupported as e:
        return None, str(e)
    except (SyntaxError, ValueError, RecursionError):
        return None, "syntax"


def from_python(df: DataFrame, key: str, source: str) -> DataFrame:
    """key, program, reason of every source that isn't null: a program, or the construct that has none."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *transpiled(s, f"py{k}")) for k, s in zip(pdf[key], pdf[source])]
            yield pd.DataFrame(rows, columns=[key, "program", "reason"])

    return df.where(F.col(source).isNotNull()).select(key, source).mapInPandas(run, f"{key} {kind}, program string, reason string")
