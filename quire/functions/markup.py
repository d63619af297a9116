"""Markup that column expressions can't read: tables of HTML, mathematics in LaTeX. Python by Arrow batches."""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a table may hold. Fixed values.
TAGS = {"table", "caption", "colgroup", "col", "thead", "tbody", "tfoot", "tr", "th", "td", "p", "span", "strong", "em", "b", "i", "sub", "sup", "br", "img"}
CELL_ATTRIBUTES = {"rowspan", "colspan", "scope", "headers"}
CLASSES = {"math-inline", "align-left", "align-center", "align-right", "numeric", "header"}
EMPTY = {"br", "col", "img"}
DROPPED = {"script", "style"}
#: Elements that the start of another one ends, though no tag closes them. Fixed values.
ENDS = {"tr": {"td", "th", "tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"td", "th", "tr", "thead", "tbody"}, "tfoot": {"td", "th", "tr", "tbody", "thead"}, "p": {"p"}}


class _Table(HTMLParser):
    """Writes the first table again: allowed elements with allowed attributes, of others the text, of scripts and comments nothing."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.open: list[str] = []
        self.deep = 0  # in an element that is dropped
        self.done = False

    def _attributes(self, tag: str, attrs: list[tuple[str, str | None]]) -> str | None:
        kept = []
        for name, value in attrs:
            name, value = name.lower(), value or ""
            if (tag in ("td", "th") and name in CELL_ATTRIBUTES) or (tag == "img" and name == "alt") or (tag == "span" and name == "data-latex"):
                kept.append((name, value))
            elif name == "class":
                classes = [c for c in value.split() if c in CLASSES]
                if classes:
                    kept.append((name, " ".join(classes)))
            elif tag == "img" and name == "src":
                if re.match(r"^\s*([a-zA-Z][a-zA-Z0-9+.-]*:|//)", value):
                    return None  # not a file of the book
                kept.append(("data-asset-id", value))
        return "".join(f' {n}="{escape(v)}"' for n, v in kept)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.done:
            return
        if tag in DROPPED:
            self.deep += 1
        if self.deep or tag not in TAGS or (not self.open and tag != "table"):
            return
        if tag == "table" and self.open:
            return  # of a table in a table the text stays
        while self.open and self.open[-1] in ENDS.get(tag, ()):
            self.out.append(f"</{self.open.pop()}>")
        found = self._attributes(tag, attrs)
        if found is None:
            return
        if tag in EMPTY:
            self.out.append(f"<{tag}{found}/>")
        else:
            self.out.append(f"<{tag}{found}>")
            self.open.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in DROPPED:
            self.deep = max(0, self.deep - 1)
        if self.done or self.deep or tag in EMPTY or tag not in self.open:
            return
        if tag == "table" and self.open.count("table") == 1:
            self.close_all()
            return
        while True:
            last = self.open.pop()
            self.out.append(f"</{last}>")
            if last == tag:
                return

    def handle_data(self, data: str) -> None:
        if self.open and not self.deep and not self.done:
            self.out.append(escape(data, quote=False))

    def close_all(self) -> None:
        while self.open:
            self.out.append(f"</{self.open.pop()}>")
        self.done = True


def clean_table(markup: str | None) -> str | None:
    """The first table of some HTML as XML that is safe to show; null without one. ``<eq>`` becomes a span with its LaTeX."""
    if markup is None or not markup.strip():
        return None
    markup = re.sub(r"(?is)<eq>(.*?)</eq>", lambda m: f'<span class="math-inline" data-latex="{escape(m.group(1).strip())}">{escape(m.group(1).strip(), quote=False)}</span>', markup)
    parser = _Table()
    parser.feed(markup)
    parser.close()
    parser.close_all()
    return re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", "".join(parser.out)) or None


# ------------------------------------------------------------------ LaTeX

# Letters, signs and words of functions with what they become. Fixed values.
LETTERS = {
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "epsilon": "ϵ", "varepsilon": "ε", "zeta": "ζ", "eta": "η", "theta": "θ", "iota": "ι", "kappa": "κ", "lambda": "λ", "mu": "μ", "nu": "ν", "xi": "ξ", "pi": "π",
    "rho": "ρ", "sigma": "σ", "tau": "τ", "upsilon": "υ", "phi": "ϕ", "varphi": "φ", "chi": "χ", "psi": "ψ", "omega": "ω", "Gamma": "Γ", "Delta": "Δ", "Theta": "Θ", "Lambda": "Λ", "Xi": "Ξ", "Pi": "Π", "Sigma": "Σ", "Phi": "Φ",
    "Psi": "Ψ", "Omega": "Ω", "infty": "∞", "partial": "∂", "nabla": "∇", "hbar": "ℏ", "ell": "ℓ", "emptyset": "∅",
}
SIGNS = {
    "times": "×", "cdot": "⋅", "div": "÷", "pm": "±", "mp": "∓", "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "approx": "≈", "equiv": "≡", "sim": "∼", "to": "→", "rightarrow": "→", "leftarrow": "←", "Rightarrow": "⇒",
    "in": "∈", "notin": "∉", "subset": "⊂", "cup": "∪", "cap": "∩", "forall": "∀", "exists": "∃", "sum": "∑", "prod": "∏", "int": "∫", "oint": "∮", "ldots": "…", "cdots": "⋯", "dots": "…", "langle": "⟨", "rangle": "⟩", "mid": "∣", "circ": "∘",
    "{": "{", "}": "}", "%": "%", "&": "&", "#": "#", "_": "_", "$": "$", "|": "‖",
}
FUNCTIONS = {"sin", "cos", "tan", "log", "ln", "exp", "lim", "max", "min", "det", "dim", "gcd", "sup", "inf", "arg"}
BIG = {"∑", "∏", "lim", "max", "min", "sup", "inf"}
FENCES = {"matrix": ("", ""), "pmatrix": ("(", ")"), "bmatrix": ("[", "]"), "vmatrix": ("|", "|"), "cases": ("{", ""), "aligned": ("", ""), "array": ("", "")}
ACCENTS = {"hat": "^", "bar": "¯", "vec": "→", "dot": "˙", "tilde": "~", "overline": "¯"}
SPACES = {",", ";", ":", "!", " ", "quad", "qquad"}
_TOKEN = re.compile(r"\\[a-zA-Z]+|\\.|[0-9]+(?:\.[0-9]+)?|\s+|.", re.S)


class _Math:
    def __init__(self, latex: str):
        self.tokens = [t for t in _TOKEN.findall(latex) if not t.isspace()]
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def next(self) -> str:
        if self.at >= len(self.tokens):
            raise ValueError("ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def want(self, token: str) -> None:
        if self.next() != token:
            raise ValueError(f"no {token}")

    def row(self, *stops: str) -> str:
        out = []
        while self.peek() is not None and self.peek() not in stops:
            out.append(self.scripted())
        return out[0] if len(out) == 1 else f"<mrow>{''.join(out)}</mrow>"

    def group(self) -> str:
        """An argument: a group in braces, or one token."""
        if self.peek() == "{":
            self.next()
            found = self.row("}")
            self.want("}")
            return found
        return self.atom()

    def name(self) -> str:
        self.want("{")
        found = []
        while self.peek() != "}":
            found.append(self.next())
        self.want("}")
        return "".join(found)

    def scripted(self) -> str:
        at = self.at
        base = "<mrow></mrow>" if self.peek() in ("^", "_") else self.atom()
        word = self.tokens[at].lstrip("\\")
        low = high = None
        while self.peek() in ("^", "_", "'"):
            mark = self.next()
            if mark == "'":
                high = (high or "") + "<mo>′</mo>"
            elif mark == "^" and high is None:
                high = self.group()
            elif mark == "_" and low is None:
                low = self.group()
            else:
                raise ValueError("two scripts")
        under = SIGNS.get(word, word) in BIG
        if low and high:
            return f"<{'munderover' if under else 'msubsup'}>{base}{low}{high}</{'munderover' if under else 'msubsup'}>"
        if low:
            return f"<{'munder' if under else 'msub'}>{base}{low}</{'munder' if under else 'msub'}>"
        return f"<msup>{base}{high}</msup>" if high else base

    def fence(self) -> str:
        token = self.next()
        sign = "" if token == "." else SIGNS.get(token[1:], token) if token[0] == "\\" else token
        return f'<mo stretchy="true">{escape(sign)}</mo>' if sign else ""

    def table(self, kind: str) -> str:
        if kind not in FENCES:
            raise ValueError(f"unknown environment {kind}")
        if kind == "array":
            self.name()
        rows, cells = [], []
        while True:
            cells.append(self.row("&", "\\\\", "\\end"))
            mark = self.next()
            if mark == "&":
                continue
            rows.append(cells)
            cells = []
            if mark == "\\end":
                break
        if self.name() != kind:
            raise ValueError("another environment ends")
        if rows[-1] == ["<mrow></mrow>"]:
            rows.pop()
        body = "".join("<mtr>" + "".join(f"<mtd>{c}</mtd>" for c in r) + "</mtr>" for r in rows)
        left, right = (f"<mo>{x}</mo>" if x else "" for x in FENCES[kind])
        return f"<mrow>{left}<mtable>{body}</mtable>{right}</mrow>"

    def atom(self) -> str:
        token = self.next()
        if token == "{":
            found = self.row("}")
            self.want("}")
            return found
        if token in ("}", "&", "^", "_", "\\\\"):
            raise ValueError(f"stray {token}")
        if token[0].isdigit():
            return f"<mn>{token}</mn>"
        if token[0] != "\\":
            return f"<mi>{escape(token)}</mi>" if token.isalpha() else f"<mo>{escape(token)}</mo>"
        word = token[1:]
        if word in ("frac", "dfrac", "tfrac"):
            return f"<mfrac>{self.group()}{self.group()}</mfrac>"
        if word == "binom":
            return f'<mrow><mo>(</mo><mfrac linethickness="0">{self.group()}{self.group()}</mfrac><mo>)</mo></mrow>'
        if word == "sqrt":
            if self.peek() == "[":
                self.next()
                index = self.row("]")
                self.want("]")
                return f"<mroot>{self.group()}{index}</mroot>"
            return f"<msqrt>{self.group()}</msqrt>"
        if word in LETTERS:
            return f"<mi>{LETTERS[word]}</mi>"
        if word in SIGNS:
            return f"<mo>{escape(SIGNS[word])}</mo>"
        if word in FUNCTIONS:
            return f"<mi>{word}</mi>"
        if word in ("mathrm", "mathbf", "mathit", "text", "operatorname"):
            return f"<{'mtext' if word == 'text' else 'mi'}>{escape(self.name())}</{'mtext' if word == 'text' else 'mi'}>"
        if word in ACCENTS:
            return f'<mover accent="true">{self.group()}<mo>{ACCENTS[word]}</mo></mover>'
        if word == "left":
            left, inner = self.fence(), self.row("\\right")
            self.want("\\right")
            return f"<mrow>{left}{inner}{self.fence()}</mrow>"
        if word == "begin":
            return self.table(self.name())
        if word in SPACES:
            return "<mspace/>"
        raise ValueError(f"unknown command {token}")


def mathml(latex: str | None, display: bool = False) -> str | None:
    """MathML of LaTeX without its delimiters; null where there is nothing, or something that isn't known."""
    if latex is None or not latex.strip():
        return None
    try:
        parser = _Math(latex)
        body = parser.row()
        if parser.peek() is not None:
            return None
    except (ValueError, IndexError, RecursionError):
        return None
    kind = ' display="block"' if display else ""
    return f'<math xmlns="http://www.w3.org/1998/Math/MathML"{kind}><semantics>{body}<annotation encoding="application/x-tex">{escape(latex.strip(), quote=False)}</annotation></semantics></math>'


@F.pandas_udf(T.StringType())
def sanitize_table(markup: pd.Series) -> pd.Series:
    return markup.map(clean_table, na_action="ignore")


@F.pandas_udf(T.StringType())
def display_mathml(latex: pd.Series) -> pd.Series:
    return latex.map(lambda x: mathml(x, True), na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def inline_mathml(latex: pd.Series) -> pd.Series:
    """Of an array of LaTeX, the MathML of each; null for those that aren't known."""
    return latex.map(lambda xs: [mathml(x) for x in xs], na_action="ignore")


def register(spark: SparkSession) -> None:
    """Gives SQL the functions sanitize_table and latex_to_mathml."""
    spark.udf.register("sanitize_table", sanitize_table)
    spark.udf.register("latex_to_mathml", display_mathml)
