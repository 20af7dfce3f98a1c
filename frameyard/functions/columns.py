"""Column functions: names and paths, hashes, number formats, and plane geometry. All stay inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename(path: C) -> Column:
    return F.substring_index(col(path), "/", -1)


def stem(path: C) -> Column:
    """File name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: C) -> Column:
    """Last suffix in lower case, with its dot; empty without one."""
    return F.lower(F.regexp_extract(basename(path), r"(?<=.)(\.[^.]+)$", 1))


def path_order(path: C) -> Column:
    """Sort key that orders paths by their parts, as a file walk does."""
    return F.split(col(path), "/")


def warning_code(w: C) -> Column:
    """The text before the first colon."""
    return F.trim(F.substring_index(col(w), ":", 1))


def fixed(x: C, digits: int) -> Column:
    """A number with so many decimals, rounded as the shortest exact decimal half to even; null and non-finite: null."""
    v = col(x).cast("double")
    pattern = "0" + ("." + "0" * digits if digits else "")
    return F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), F.call_function("format_number", v, F.lit(pattern)))


def content_hash(content: C) -> Column:
    return F.sha2(col(content), 256)


def hex_modulo(digest: C, n: int, digits: int = 8) -> Column:
    """The first hex digits as an integer modulo n."""
    return F.conv(F.substring(col(digest), 1, digits), 16, 10).cast("long") % n


def md5_modulo_5(text: C) -> Column:
    """md5 as an integer modulo 5. 16 is 1 modulo 5, so the digits' sum decides."""
    digits = F.split(F.md5(col(text).cast("binary")), "")
    value = lambda d: F.instr(F.lit("0123456789abcdef"), d) - 1
    summed = F.aggregate(F.filter(digits, lambda d: d != ""), F.lit(0), lambda a, d: a + value(d))
    return summed % 5


def hamming(a: C, b: C) -> Column:
    return F.bit_count(col(a).bitwiseXOR(col(b)))


def cosine(a: C, b: C) -> Column:
    """Cosine in double precision; null if a vector is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(col(x), col(y), lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def clamp(x: C, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), col(x)))


def all_true(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def messages(*pairs: tuple[Column, Column | str]) -> Column:
    """The texts whose condition holds, in the given order. A null condition does not hold. Parts are concatenated, not
    filtered: Spark interprets all that stands under a higher-order function, and that would be every check."""
    none = F.array().cast("array<string>")
    text = lambda m: F.lit(m) if isinstance(m, str) else m
    return F.concat(none, *(F.when(c & text(m).isNotNull(), F.array(text(m))).otherwise(none) for c, m in pairs))


def first_message(*pairs: tuple[Column, Column | str]) -> Column:
    """The text of the first condition that holds, else null."""
    out = None
    for c, m in pairs:
        m = F.lit(m) if isinstance(m, str) else m
        out = F.when(c, m) if out is None else out.when(c, m)
    return out


def orientation(front_x: C, rear_x: C, eps: float = 1.0) -> Column:
    """ambiguous within eps pixels, else the side that the front is on."""
    dx = col(front_x) - col(rear_x)
    return F.when(F.abs(dx) <= eps, "ambiguous").when(dx > 0, "right-looking").when(dx <= 0, "left-looking")


def geometry_score(wheelbase: C, radius: C, ground_dy: C) -> Column:
    """Quality of wheel geometry in [0, 1]."""
    align = 1.0 - F.least(F.lit(1.0), col(ground_dy) / F.greatest(col(radius) * 0.8, F.lit(1.0)))
    return 0.4 * clamp(col(wheelbase) / 180.0) + 0.3 * clamp(col(radius) / 35.0) + 0.3 * align


def confidence_in(description: C) -> Column:
    """The number behind "confidence=" in a description, letters in either case; null if there is none."""
    return F.expr(f"try_cast(nullif(regexp_extract({description}, '(?i)confidence\\\\s*=\\\\s*([0-9]*\\\\.?[0-9]+)', 1), '') AS double)") if isinstance(
        description, str
    ) else F.nullif(F.regexp_extract(description, r"(?i)confidence\s*=\s*([0-9]*\.?[0-9]+)", 1), F.lit("")).cast("double")
