"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base rules find plain e-mail addresses, IPv4 addresses, card numbers and phone
numbers; these always stay. High-recall generators propose further, overlapping
spans (obfuscated addresses, national phone formats, unusual separators, IPv6).
Boosted trees score them by format and context, and a threshold per kind,
calibrated on rows kept from training, selects those that are added. An added
span overlaps no base span and no added span of a higher score.

Trees are trained on the driver from a fixed number of generated examples whose
features come from the same expressions as everywhere, and are compiled into
CASE expressions: texts never leave the JVM. Positions come from cutting a text
at all matches: the lengths of pieces and matches add up to code points.

Patterns that could scan a run again from each of its characters only start at
the run's beginning or at the end of the match before, which finds the same
matches in linear time.

Defined results: a null text is an empty one; rows that share a doc_id stay
apart; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
AT = r"(?i:\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20|\x20?@\x20?)"
DOT = r"(?i:\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20|\.)"
LABEL = "[A-Za-z0-9-]++"
V4 = r"(?i:\[\.\]|\(\.\)|\[dot\]|\x20dot\x20)[0-9]{1,3}"
V6 = r"(?:[0-9A-Fa-f]{1,4}::?){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:]|\.[0-9])"
#: Where candidates start, also inside of others: what stands before, the least shape, and how much behind it is looked at.
STARTS = {
    "email": (rf"(?<!{LOCAL})", rf"{LOCAL}++{AT}{LABEL}{DOT}{LABEL}", 300),
    "ip": (r"(?<![0-9A-Fa-f:.])", rf"(?:[0-9]{{1,3}}(?:{V4}){{3}}|{V6})", 40),
    "card": (r"(?<![0-9])", r"[0-9](?:[\x20._/-]{0,2}[0-9]){11}", 60),
    "phone": (r"(?<![0-9])", r"\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6}", 100),
}
#: The spans tried from each start: one for every number of labels, digits or groups.
VARIANTS = {
    "email": [rf"{LOCAL}++{AT}{LABEL}(?:{DOT}{LABEL}){n}" for n in ("{1}", "{2}", "{3}", "++")],
    "ip": [rf"[0-9]{{1,3}}(?:{V4}){{3}}(?![0-9])", V6],
    "card": [rf"[0-9](?:[\x20._/-]{{0,2}}[0-9]){{{n}}}(?![0-9])" for n in range(11, 19)],
    "phone": [r"[0-9]{7,13}(?![0-9])", *(rf"\(?[0-9]{{2,5}}(?:[\x20()./-]{{1,2}}[0-9]{{2,9}}){{{n}}}(?![0-9])" for n in range(1, 6))],
}
BALANCED = r"^[^()]*(?:\([^()]*\)[^()]*)*$"
CONTEXT = 32
WORDS_FOR = r"(?i)(?:tel|phone|fon|call|mobil|contact|kontakt|llam|appel|fax|e-?mail|courriel|correo|write|reach|whatsapp|server|host|addr|ip\b|card|karte|carte|tarjeta|visa|credit|pay)"
WORDS_AGAINST = r"(?i)(?:order|invoice|isbn|version|date|page|seite|serial|item|part|build|time|nr\.|no\.|ref|sku|id\b|chapter|section|score|between|from)"
FEATURES = ("f_kind", "f_length", "f_digits", "f_groups", "f_longest", "f_shortest", "f_parens", "f_dashes", "f_dots", "f_spaces", "f_slashes", "f_colons", "f_zero", "f_luhn", "f_byte", "f_at", "f_dot", "f_for", "f_against", "f_glued", "f_more")
TREES, DEPTH, RATE = 40, 3, 0.3
PRECISION = 0.99


def luhn(digits: Column) -> Column:
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    twice = F.translate(F.regexp_replace(even, "(.).", "$1"), "0123456789", "0246813579")
    each = F.concat(twice, F.regexp_replace(even, ".(.)", "$1"))
    total = F.aggregate(F.regexp_extract_all(each, F.lit("."), F.lit(0)), F.lit(0), lambda acc, d: acc + d.cast("int"))
    return F.when(F.length(digits) > 0, total % 10 == 0).otherwise(F.lit(False))


def _base_holds(kind: Column, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    small = F.forall(F.split(found, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) == 0) | ((F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(999)) <= 255)))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", small)
        .when(kind == "card", F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False)))
        .otherwise(F.length(digits).between(9, 15))
    )


def _cuts(text: Column, pattern: str, wanted: Column, kind: str, base: bool) -> Column:
    """All matches of one pattern with the pieces before and behind them."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.transform(
        F.arrays_zip(found.alias("m"), F.slice(pieces, 1, F.size(found)).alias("p"), F.slice(pieces, 2, F.size(found)).alias("q")),
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"), F.lit(base).alias("base"), i.alias("i"), z["m"].alias("found"),
            F.length(z["p"]).alias("gap"), F.right(z["p"], F.lit(CONTEXT)).alias("before"), F.left(z["q"], F.lit(CONTEXT)).alias("after"),
        ),
    )
    return F.when(wanted, rows)


def _starts(text: Column, kind: str, wanted: Column) -> Column:
    """All starts of candidates, as rows of ``_cuts``: found is the text from there on, and gaps lead from start to start.

    A character is put before the text, since a split makes no piece before an empty match at 0.
    """
    behind, shape, reach = STARTS[kind]
    pattern = rf"{behind}(?=({shape}[\s\S]{{0,{reach}}}))"
    text = F.concat(F.lit("\n"), text)
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    rows = F.transform(
        F.arrays_zip(found.alias("m"), F.slice(pieces, 1, F.size(found)).alias("p")),
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"), F.lit(False).alias("base"), i.alias("i"), z["m"].alias("found"),
            F.length(z["p"]).alias("gap"), F.right(z["p"], F.lit(CONTEXT)).alias("before"), F.lit("").alias("after"),
        ),
    )
    return F.when(wanted, rows)


def _fits(kind: Column, found: Column) -> Column:
    """The right check digit of a card; the length of a phone number, and its brackets in pairs."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    return (found != "") & F.when(kind == "phone", F.length(digits).between(7, 17) & found.rlike(BALANCED)).when(kind == "card", luhn(digits)).otherwise(F.lit(True))


def _variants(kind: Column, rest: Column) -> Column:
    """The distinct spans at the beginning of ``rest``."""
    per_kind = [F.when(kind == k, F.array(*[F.regexp_extract(rest, f"^(?:{v})", 0) for v in VARIANTS[k]])) for k in KINDS]
    return F.array_distinct(F.coalesce(*per_kind))


def _candidates(kind: str, text: str) -> list[tuple[int, int]]:
    """(start, stop) of the candidates in a text of the training examples, in Python."""
    behind, shape, _ = STARTS[kind]
    found = {m.span() for s in re.finditer(f"{behind}(?={shape})", text) for v in VARIANTS[kind] if (m := re.compile(v).match(text, s.start()))}
    ok = lambda x: kind != "phone" or (7 <= sum(c.isdigit() for c in x) <= 17 and re.match(BALANCED, x))
    return sorted(f for f in found if ok(text[f[0] : f[1]]))


def _count(found: Column, pattern: str) -> Column:
    return F.regexp_count(found, F.lit(pattern)).cast("double")


def with_features(rows: DataFrame) -> DataFrame:
    """Add the format and context features of (kind, found, before, after)."""
    found, kind = F.col("found"), F.col("kind")
    groups = F.regexp_extract_all(found, F.lit("[0-9]+"), F.lit(0))
    sizes = F.transform(groups, lambda g: F.length(g))
    digits = F.regexp_replace(found, "[^0-9]", "")
    near = F.length(digits).between(12, 19)
    number = F.forall(groups, lambda g: (F.length(g) <= 3) & (F.coalesce(g.try_cast("int"), F.lit(999)) <= 255))
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    made = {
        "f_kind": F.array_position(F.lit(list(KINDS)), kind).cast("double"),
        "f_length": F.length(found).cast("double"),
        "f_digits": F.length(digits).cast("double"),
        "f_groups": F.size(groups).cast("double"),
        "f_longest": F.coalesce(F.array_max(sizes), F.lit(0)).cast("double"),
        "f_shortest": F.coalesce(F.array_min(sizes), F.lit(0)).cast("double"),
        "f_parens": _count(found, r"[()\[\]{}]"),
        "f_dashes": _count(found, "-"),
        "f_dots": _count(found, r"\."),
        "f_spaces": _count(found, r"\x20"),
        "f_slashes": _count(found, "[/_]"),
        "f_colons": _count(found, ":"),
        "f_zero": yes(found.rlike(r"^\(?0")),
        "f_luhn": yes(F.when(near, luhn(digits)).otherwise(F.lit(False))),
        "f_byte": yes(number),
        "f_at": yes(found.rlike(r"(?i)[\[({]\x20?at|@")),
        "f_dot": yes(found.rlike(r"(?i)[\[({]\x20?dot|\x20dot\x20")),
        "f_for": yes(F.col("before").rlike(WORDS_FOR)),
        "f_against": yes(F.col("before").rlike(WORDS_AGAINST)),
        "f_glued": yes(F.col("before").rlike(r"[A-Za-z0-9_=/#.-]$") | F.col("after").rlike(r"^(?:[A-Za-z0-9_=/#%]|\.[0-9])")),
        "f_more": yes(F.col("before").rlike(r"[0-9][./_-]$")) + yes(F.col("after").rlike(r"^[./_-][0-9]")),
    }
    return rows.withColumns(made)


def _examples(n: int = 400, seed: int = 11) -> list[tuple[str, str, str, str, int]]:
    """Generated (kind, found, before, after, is personal data)."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("aeiorstnlch") for _ in range(rng.randint(2, 8)))
    plain = lambda: f"{word()} {word()} "
    asks = lambda xs: plain() + rng.choice(xs)

    def card() -> str:
        body = rng.choice("3456") + digits(rng.choice((14, 14, 13)))
        for last in "0123456789":
            total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(body + last))))
            if total % 10 == 0:
                return body + last
        raise AssertionError

    def split(text: str, sep: str) -> str:
        return sep.join(text[i : i + 4] for i in range(0, len(text), 4))

    def email(hidden: bool) -> str:
        at = rng.choice((" [at] ", "[at]", " (at) ", "(at)", " {at} ")) if hidden else rng.choice((" at ", " @ "))
        dot = rng.choice((" [dot] ", "[dot]", " (dot) ", ".", " dot ")) if hidden else rng.choice((" dot ", ".", "."))
        return f"{word()}{rng.choice(('', '.' + word(), digits(2)))}{at}{word()}{dot}{rng.choice(('com', 'org', 'net', 'de'))}"

    phones = (
        lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}", lambda: f"0{digits(3)} {digits(6)}",
        lambda: f"00{digits(2)} {digits(3)} {digits(7)}", lambda: f"0{digits(2)}/{digits(7)}", lambda: f"0{digits(1)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}",
    )
    numbers = (
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: f"{rng.randint(10, 28)}/{rng.randint(10, 12)}/{rng.randint(1990, 2030)}", lambda: f"{digits(2)} {digits(2)}",
        lambda: f"{digits(4)}-{digits(4)}", lambda: f"{digits(3)} {digits(3)} {digits(3)}", lambda: f"{digits(5)}-{digits(2)}", lambda: f"{digits(2)}.{digits(2)}.{rng.randint(1950, 2030)}", lambda: f"978-{digits(1)}-{digits(4)}-{digits(4)}",
    )
    asking = ("tel: ", "phone ", "call me at ", "Telefon ", "mobile: ", "fax ", "contact: ")
    against = ("order ", "invoice no. ", "version ", "date ", "ISBN ", "serial ", "ref ")
    rows = []
    for _ in range(n):
        end = rng.choice((" ", ". ", ", ", "\n", ""))
        rows.append(("phone", rng.choice(phones[:2])(), rng.choice((plain, lambda: asks(asking)))(), end, 1))
        rows.append(("phone", rng.choice(phones)(), asks(asking), end, 1))
        rows.append(("phone", rng.choice(numbers)(), rng.choice((plain, lambda: asks(against)))(), end, 0))
        rows.append(("phone", rng.choice(numbers + phones[2:])(), rng.choice((plain, lambda: asks(against)))(), end, 0))
        rows.append(("card", split(card(), rng.choice((".", "  ", " - ", "/", "_", "-", " "))), rng.choice((plain, lambda: asks(("card ", "visa: ", "Karte "))))(), end, 1))
        odd = card()
        rows.append(("card", split(odd[:-1] + str((int(odd[-1]) + rng.randint(1, 9)) % 10), rng.choice((".", " ", "-", ""))), rng.choice((plain, lambda: asks(against)))(), end, 0))
        rows.append(("phone", split(card(), rng.choice((".", " ", "-", "/"))), rng.choice((plain, lambda: asks(("card ", "visa: ", "Karte "))))(), end, 0))
        rows.append(("card", digits(rng.randint(12, 19)), plain() + rng.choice(("id=", "x", "#", "/")), rng.choice(("a", "f0", "/", "")), 0))
        rows.append(("email", email(True), rng.choice((plain, lambda: asks(("mail ", "contact: ", "write to "))))(), end, 1))
        rows.append(("email", email(False), plain(), end, 0))
        rows.append(("ip", rng.choice(("[.]", "(.)", "[dot]")).join(str(rng.randint(1, 255)) for _ in range(4)), rng.choice((plain, lambda: asks(("server ", "host "))))(), end, 1))
        rows.append(("ip", ":".join("%x" % rng.randint(4096, 65535) for _ in range(8)), rng.choice((plain, lambda: asks(("ip ", "host "))))(), end, 1))
        rows.append(("ip", ":".join(digits(2) for _ in range(rng.randint(3, 4))), rng.choice((plain, lambda: asks(("time ", "from "))))(), end, 0))
        rows.append(("ip", ":".join("%02x" % rng.randint(0, 255) for _ in range(6)), plain(), end, 0))
    # Numbers beside others: of all spans that the generators propose, only the whole numbers are right.
    for _ in range(n // 4):
        sep = rng.choice((" ", " ", ", ", " / ", "; ", "\n", " | "))
        one, two, end = rng.choice(phones[:2]), rng.choice(phones[:2]), rng.choice((" ", ". ", ", ", "\n", ""))
        dashed = lambda make: make().replace("-", rng.choice("--.")) if make is phones[1] else make()
        number = split(card(), rng.choice((".", "/", "-", " ")))
        lead = rng.choice((plain, lambda: asks(asking)))()
        for kind, parts in (
            ("phone", (("", 0), (dashed(one), 1), (sep, 0), (dashed(two), 1))),
            ("phone", ((digits(rng.randint(2, 4)), 0), (" ", 0), (dashed(one), 1))),
            ("phone", ((number, 0), (sep, 0), (digits(2), 0))),
            ("card", ((digits(rng.randint(2, 4)), 0), (" ", 0), (number, 1), (sep, 0), (digits(3), 0))),
        ):
            text, right = lead, set()
            for part, y in parts:
                if y:
                    right.add((len(text), len(text) + len(part)))
                text += part
            text += end
            for a, b in _candidates(kind, text):
                chance = any(a <= r[0] and r[1] <= b or r[0] <= a and b <= r[1] for r in right) or rng.random() < 0.3
                if chance or (a, b) in right:
                    rows.append((kind, text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT], int((a, b) in right)))
        bare = rng.choice(("", "0")) + digits(rng.choice((9, 10, 10)))
        rows.append(("phone", bare, plain() + rng.choice(asking), end, 1))
        rows.append(("phone", digits(rng.randint(7, 13)), rng.choice((plain(), asks(against), plain() + "id=")), end, 0))
    return rows


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int):
    """A regression tree as nested tuples (feature, cut, left, right), or a leaf's value."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, None, None)
    if depth:
        for f in range(x.shape[1]):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, gs, hs = x[order, f], np.cumsum(grad[order])[:-1], np.cumsum(hess[order])[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[v[1:] == v[:-1]] = -1
            if len(gain) and gain.max() > best[0]:
                k = int(gain.argmax())
                best = (float(gain[k]), f, float((v[k] + v[k + 1]) / 2))
    if best[1] is None:
        return float(RATE * g / (h + 1))
    left = x[rows, best[1]] < best[2]
    return best[1], best[2], _tree(x, grad, hess, rows[left], depth - 1), _tree(x, grad, hess, rows[~left], depth - 1)


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] < tree[1], _apply(tree[2], x), _apply(tree[3], x))


def _sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    return f"CASE WHEN {FEATURES[tree[0]]} < {tree[1]!r}D THEN {_sql(tree[2])} ELSE {_sql(tree[3])} END"


@lru_cache(1)
def _trained(session: SparkSession) -> tuple[str, dict[str, float]]:
    """Score expression, and the least score selected for each kind."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = _examples()
    values = ", ".join(f"({i}, {quote(k)}, {quote(f)}, {quote(b)}, {quote(a)}, {y})" for i, (k, f, b, a, y) in enumerate(rows))
    table = session.sql(f"SELECT * FROM VALUES {values} AS t(row, kind, found, before, after, y)")
    got = with_features(table).select("row", "y", *FEATURES).orderBy("row").collect()
    x, y = np.array([r[2:] for r in got], float), np.array([r[1] for r in got], float)
    fold = np.arange(len(y)) % 14 % 4 == np.arange(len(y)) // 14 % 4
    fit = np.flatnonzero(~fold)
    score, trees = np.zeros(len(y)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        trees.append(_tree(x, y - p, p * (1 - p), fit, DEPTH))
        score += _apply(trees[-1], x)
    least = {}
    for k, kind in enumerate(KINDS, 1):
        rows_ = np.flatnonzero(fold & (x[:, 0] == k))
        order = rows_[np.argsort(-score[rows_], kind="stable")]
        right = np.cumsum(y[order]) / np.arange(1, len(order) + 1)
        fine = np.flatnonzero(right >= PRECISION)
        # Half way to the next lower score, and never below even odds.
        at = int(fine.max()) if len(fine) else -1
        low = score[order[at + 1]] if at + 1 < len(order) else score[order[at]] - 1
        least[kind] = max(0.0, float((score[order[at]] + low) / 2)) if at >= 0 else float("inf")
    return " + ".join(_sql(t) for t in trees), least


def spans(docs: DataFrame) -> DataFrame:
    """One row per document and span: row_id, doc_id, kind, rank, base, start, stop; a null kind if none."""
    text = F.coalesce("text", F.lit(""))
    at, digit = F.contains(F.col("t"), F.lit("@")), F.col("t").rlike("[0-9]")
    hidden = F.col("t").rlike(r"(?i)(?:[\[({]\x20?at\x20?[\])}]|\x20at\x20|@)")
    wanted = {"email": at, "ip": digit, "card": digit, "phone": F.contains(F.col("t"), F.lit("+"))}
    more = {"email": hidden, "ip": digit, "card": digit, "phone": digit}
    named = docs.select("doc_id", text.alias("t")).withColumn("row_id", F.monotonically_increasing_id())
    parts = [_cuts(F.col("t"), BASE[k], wanted[k], k, True) for k in KINDS] + [_starts(F.col("t"), k, more[k]) for k in KINDS]
    cut = F.array_compact(F.flatten(F.array_compact(F.array(*parts))))
    rows = named.select("row_id", "doc_id", F.explode_outer(cut).alias("c")).select("row_id", "doc_id", "c.*").repartition("row_id")
    w = Window.partitionBy("row_id", "kind", "base").orderBy("i")
    at = F.sum(F.col("gap") + F.when(F.col("base"), F.length("found")).otherwise(0)).over(w)
    lead = F.right(F.array_join(F.collect_list("before").over(w.rowsBetween(-CONTEXT, 0)), ""), F.lit(CONTEXT))
    rows = rows.withColumn("start", at - F.when(F.col("base"), F.length("found")).otherwise(1)).withColumn("before", F.when(F.col("base"), F.col("before")).otherwise(F.ltrim(lead, F.lit("\n"))))
    # Starts without a span stay out, rows without a start stay.
    tried = F.filter(_variants(F.col("kind"), F.col("found")), lambda v: _fits(F.col("kind"), v))
    rows = rows.withColumn("rest", F.col("found")).withColumn("found", F.explode_outer(F.when(~F.col("base"), tried).otherwise(F.array("found"))))
    rows = rows.withColumn("after", F.when(F.col("base"), F.col("after")).otherwise(F.substr("rest", F.length("found") + 1, F.lit(CONTEXT)))).drop("rest")
    rows = rows.withColumn("stop", F.col("start") + F.length("found"))
    return rows.withColumn("rank", F.array_position(F.lit(list(KINDS)), F.col("kind")).cast("int"))


def select(rows: DataFrame) -> DataFrame:
    """Add ``score``, ``keep`` of the valid base spans, and ``run`` of the added spans that may be kept.

    These have enough score and overlap no valid base span; spans of different
    runs do not overlap.
    """
    expr, least = _trained(rows.sparkSession)
    bar = F.coalesce(*[F.when(F.col("kind") == k, F.lit(least[k])) for k in KINDS])
    scored = with_features(rows).withColumn("score", F.expr(expr)).drop(*FEATURES)
    holds = F.coalesce(_base_holds(F.col("kind"), F.col("found")), F.lit(False))
    able = scored.withColumn("keep", F.coalesce(F.col("base") & holds, F.lit(False))).withColumn("able", F.coalesce(~F.col("base") & F.col("found").isNotNull() & (F.col("score") >= bar), F.lit(False)))
    # The farthest end of base spans that start before, the nearest start of those that start behind.
    to, back = Window.partitionBy("row_id").orderBy("start"), Window.partitionBy("row_id").orderBy(F.desc("start"))
    end = F.max(F.when(F.col("keep"), F.col("stop"))).over(to.rangeBetween(Window.unboundedPreceding, 0))
    begin = F.min(F.when(F.col("keep"), F.col("start"))).over(back.rangeBetween(Window.unboundedPreceding, 0))
    able = able.withColumn("end", end).withColumn("begin", begin)
    able = able.withColumn("able", F.col("able") & ~F.coalesce((F.col("end") > F.col("start")) | (F.col("begin") < F.col("stop")), F.lit(False))).drop("end", "begin")
    order = Window.partitionBy("row_id", "able").orderBy("start", "stop", "rank")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("start") < F.col("reach"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return able.withColumn("reach", reach).withColumn("run", F.when(F.col("able"), run)).drop("reach", "able")


def _greedy(added: Column) -> Column:
    """Of (worse, shorter, start, rank, stop, kind) in order, those that overlap none kept before."""
    kept = F.filter(added, lambda s: F.lit(False))
    return F.aggregate(F.array_sort(added), kept, lambda acc, s: F.when(F.exists(acc, lambda k: (k["start"] < s["stop"]) & (s["start"] < k["stop"])), acc).otherwise(F.concat(acc, F.array(s))))


def _listed(rows: Column) -> Column:
    ordered = F.array_sort(rows)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans."""
    kept = select(spans(docs))
    span = F.struct("start", "rank", "stop", "kind")
    worth = F.struct((-F.col("score")).alias("worse"), (F.col("start") - F.col("stop")).alias("shorter"), "start", "rank", "stop", "kind")
    counts = [F.count_if(F.col("keep") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS]
    runs = kept.groupBy("row_id", "run").agg(F.first("doc_id").alias("doc_id"), *counts, F.collect_list(F.when(F.col("keep"), span)).alias("plain"), F.collect_list(F.when(F.col("run").isNotNull(), worth)).alias("added"))
    added = F.transform(_greedy(F.col("added")), lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    sums = [F.sum(f"n_{k}").alias(f"n_{k}") for k in KINDS]
    out = runs.withColumn("added", added).groupBy("row_id").agg(F.first("doc_id").alias("doc_id"), *sums, F.flatten(F.collect_list("plain")).alias("plain"), F.flatten(F.collect_list("added")).alias("added"))
    plain, every = _listed(F.col("plain")), _listed(F.concat("plain", "added"))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(plain.cast("binary"), 256).alias("base_sha256"), every.alias("spans"))
