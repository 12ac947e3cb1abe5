"""Row expressions in data-frame syntax, as Spark SQL.

Text is parsed as a Python expression (``&`` and the bar mean and/or, names in back quotes may
hold anything), so nothing inside a string literal is touched. What isn't one is taken as SQL.
Division by zero gives null; ``a != b`` holds where one side is null, as in data frames.
"""

from __future__ import annotations

import ast
import io
import re
import tokenize

#: Operators of the expression syntax, and methods without arguments.
BINARY = {ast.Add: "({} + {})", ast.Sub: "({} - {})", ast.Mult: "({} * {})", ast.Div: "try_divide({}, {})", ast.Pow: "pow({}, {})", ast.FloorDiv: "floor(try_divide({}, {}))", ast.Mod: "({0} - {1} * floor(try_divide({0}, {1})))"}
COMPARE = {ast.Eq: "({} = {})", ast.NotEq: "(NOT ({} <=> {}))", ast.Lt: "({} < {})", ast.LtE: "({} <= {})", ast.Gt: "({} > {})", ast.GtE: "({} >= {})", ast.Is: "({} <=> {})", ast.IsNot: "(NOT ({} <=> {}))"}
METHODS = {"abs": "abs({})", "isna": "({} IS NULL)", "isnull": "({} IS NULL)", "notna": "({} IS NOT NULL)", "notnull": "({} IS NOT NULL)", "floor": "floor({})", "ceil": "ceil({})", "lower": "lower({})", "upper": "upper({})", "strip": "trim({})"}
WITH_VALUE = {"fillna": "coalesce({}, {})", "startswith": "startswith({}, {})", "endswith": "endswith({}, {})", "contains": "contains({}, {})", "round": "round({}, {})", "between": "({0} >= {1} AND {0} <= {2})"}
DATE_PARTS = {"year": "year({})", "month": "month({})", "day": "day({})", "dayofweek": "weekday({})", "quarter": "quarter({})", "dayofyear": "dayofyear({})"}


class NotAnExpression(ValueError):
    pass


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int | float):
        return repr(value) + ("D" if isinstance(value, float) else "")
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Sql(ast.NodeVisitor):
    def __init__(self, names: dict[str, str]) -> None:
        self.names = names

    def generic_visit(self, node: ast.AST) -> str:
        raise NotAnExpression(f"not allowed in an expression: {type(node).__name__}")

    def visit_Expression(self, node: ast.Expression) -> str:
        return self.visit(node.body)

    def visit_Constant(self, node: ast.Constant) -> str:
        return _literal(node.value)

    def visit_Name(self, node: ast.Name) -> str:
        return f"`{self.names.get(node.id, node.id)}`"

    def visit_List(self, node: ast.List) -> str:
        return "(" + ", ".join(map(self.visit, node.elts)) + ")"

    visit_Tuple = visit_Set = visit_List

    def visit_BoolOp(self, node: ast.BoolOp) -> str:
        return "(" + (" AND " if isinstance(node.op, ast.And) else " OR ").join(map(self.visit, node.values)) + ")"

    def visit_UnaryOp(self, node: ast.UnaryOp) -> str:
        inner = self.visit(node.operand)
        return f"(NOT coalesce({inner}, false))" if isinstance(node.op, ast.Not | ast.Invert) else f"({'-' if isinstance(node.op, ast.USub) else ''}{inner})"

    def visit_BinOp(self, node: ast.BinOp) -> str:
        if type(node.op) not in BINARY:
            return self.generic_visit(node.op)
        return BINARY[type(node.op)].format(self.visit(node.left), self.visit(node.right))

    def visit_Compare(self, node: ast.Compare) -> str:
        parts, left = [], node.left
        for op, right in zip(node.ops, node.comparators, strict=True):
            a, b = self.visit(left), self.visit(right)
            if isinstance(op, ast.In | ast.NotIn):
                parts.append(f"(NOT coalesce({a} IN {b}, false))" if isinstance(op, ast.NotIn) else f"({a} IN {b})")
            else:
                parts.append(COMPARE[type(op)].format(a, b))
            left = right
        return parts[0] if len(parts) == 1 else "(" + " AND ".join(parts) + ")"

    def visit_IfExp(self, node: ast.IfExp) -> str:
        return f"if({self.visit(node.test)}, {self.visit(node.body)}, {self.visit(node.orelse)})"

    def visit_Attribute(self, node: ast.Attribute) -> str:
        if node.attr in ("str", "dt"):
            return self.visit(node.value)
        if isinstance(node.value, ast.Attribute) and node.value.attr == "dt" and node.attr in DATE_PARTS:
            return DATE_PARTS[node.attr].format(self.visit(node.value))
        return f"{self.visit(node.value)}.`{node.attr}`"

    def visit_Call(self, node: ast.Call) -> str:
        given = {k.arg: self.visit(k.value) for k in node.keywords}
        args = [self.visit(a) for a in node.args]
        if isinstance(node.func, ast.Name):
            if given:
                raise NotAnExpression("functions take no named arguments")
            return f"{node.func.id}({', '.join(args)})"
        if not isinstance(node.func, ast.Attribute):
            return self.generic_visit(node.func)
        name, value = node.func.attr, self.visit(node.func.value)
        if name == "clip":
            low, high = [*args, None, None][:2]
            low, high = given.get("lower", low), given.get("upper", high)
            out = value if low in (None, "NULL") else f"greatest({value}, {low})"
            out = out if high in (None, "NULL") else f"least({out}, {high})"
            return f"if({value} IS NULL, NULL, {out})"
        if name == "isin":
            return f"({value} IN {args[0]})"
        if name == "astype":
            return f"try_cast({value} AS {dict(float='double', int='bigint', str='string', bool='boolean').get(args[0].strip(chr(39) + '`'), 'string')})"
        if name in METHODS and not args:
            return METHODS[name].format(value)
        if name in WITH_VALUE:
            return WITH_VALUE[name].format(value, *args, *given.values())
        raise NotAnExpression(f"unknown method {name}")


def _python(text: str, names: dict[str, str]) -> str:
    """The text with quoted names replaced, and the signs for and/or as words."""

    def named(m: re.Match) -> str:
        if m[0][0] != "`":
            return m[0]
        key = f"quoted_{len(names)}_name"
        names[key] = m[0][1:-1]
        return key

    text = re.sub(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`", named, text)
    words = {"&": "and", "|": "or", "&&": "and", "||": "or"}
    out = [(t.type, f" {words[t.string]} " if t.type == tokenize.OP and t.string in words else t.string) for t in tokenize.generate_tokens(io.StringIO(text.strip()).readline)]
    return " ".join(s for _, s in out).strip()


def translate_expression(text: str) -> str:
    """A data-frame expression as SQL; text that doesn't parse as one is SQL already."""
    names: dict[str, str] = {}
    try:
        parsed = ast.parse(_python(text, names), mode="eval")
    except (SyntaxError, tokenize.TokenError, IndentationError):
        return text
    return _Sql(names).visit(parsed)


def inputs_of(text: str) -> set[str]:
    """Names of the columns that an expression reads (empty for SQL)."""
    names: dict[str, str] = {}
    try:
        parsed = ast.parse(_python(text, names), mode="eval")
    except (SyntaxError, tokenize.TokenError, IndentationError):
        return set()
    called = {id(n.func) for n in ast.walk(parsed) if isinstance(n, ast.Call)}
    return {names.get(n.id, n.id) for n in ast.walk(parsed) if isinstance(n, ast.Name) and id(n) not in called}
