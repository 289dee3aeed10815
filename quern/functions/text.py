"""Text helpers: Column in, Column out, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(_c(x), rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def lstrip(x) -> Column:
    return F.regexp_replace(_c(x), rf"(?U)\A{SPACE}+", "")


def is_blank(x) -> Column:
    return F.coalesce(F.length(strip(x)) == 0, F.lit(True))


def same_text(a, b) -> Column:
    """Equality without case and surrounding white space."""
    return F.lower(strip(a)) == F.lower(strip(b))


def upper_each(x) -> Column:
    """Upper case, code point by code point: none becomes several (ß is ẞ, ŉ stays)."""

    def one(c: Column) -> Column:
        up, title = F.upper(c), F.initcap(c)
        return F.when(c == "ß", "ẞ").when(F.length(up) == 1, up).when(F.length(title) == 1, title).otherwise(c)

    return F.array_join(F.transform(F.split(_c(x), ""), one), "")


def lower_each(x) -> Column:
    """Lower case, code point by code point, whatever stands beside it (Σ is σ, İ is i)."""
    return F.array_join(F.transform(F.split(_c(x), ""), lambda c: F.when(c == "İ", "i").otherwise(F.lower(c))), "")


def straight_quotes(x) -> Column:
    return F.translate(_c(x), "“”", '""')


def first_part(x, separator: str) -> Column:
    return F.substring_index(_c(x), separator, 1)


def last_part(x, separator: str) -> Column:
    return F.substring_index(_c(x), separator, -1)


def preview(x, size: int = 100, dots: bool = False) -> Column:
    """The first line, cut at ``size`` characters; with ``dots`` a full one gets an ellipsis."""
    line = F.substring(F.get(F.split(_c(x), r"\R"), F.lit(0)), 1, size)
    return F.when(F.length(line) == size, F.concat(line, F.lit("..."))).otherwise(line) if dots else line


def word_count(x) -> Column:
    """Runs of letters, digits, underscores, apostrophes and hyphens, in any script."""
    return F.regexp_count(_c(x), F.lit(r"[\p{L}\p{N}_'-]+"))


def space_count(x) -> Column:
    """Pieces between single spaces, empty ones included."""
    return F.size(F.split(_c(x), " ", -1))


def replace_all(x, pairs: list[tuple[str, str]]) -> Column:
    """A chain of regular-expression replacements."""
    out = _c(x)
    for pattern, by in pairs:
        out = F.regexp_replace(out, pattern, by)
    return out


def without_prefix(x, prefix) -> Column:
    x, prefix = _c(x), _c(prefix)
    return F.when(F.startswith(x, prefix), F.substr(x, F.length(prefix) + 1)).otherwise(x)


def before_any(x, pattern: str) -> Column:
    """What stands before the first match."""
    return F.get(F.split(_c(x), pattern, 2), F.lit(0))


def drop_role_tags(x) -> Column:
    """Without role tags that a response ends in."""
    return F.regexp_replace(_c(x), r"[\s\n]*(USER|ASSISTANT):\s*\z", "")


def squeeze_spaces(x) -> Column:
    return F.regexp_replace(_c(x), " +", " ")


def tidy_actions(x, delimiter: str) -> Column:
    """Stray delimiters of role-play actions, quotes and repeated spaces set right."""
    d = "".join("\\" + c if not c.isalnum() and c != "_" else c for c in delimiter)
    by = delimiter.replace("\\", "\\\\").replace("$", "\\$")
    return replace_all(
        x,
        [
            (rf'({d})([\.,\s-]*){d}\s*"', '$1 "'),
            (rf'"([\W]{{0,2}})"({d})', '"$1$2'),
            (rf'({d})"([\W]{{0,2}})"', '$1$2"'),
            (rf"{d}\(|\){d}", by),
            (rf"[,\.]{d}", by),
            (rf"({d})[,\.](\s)", "$1$2"),
            (" +", " "),
        ],
    )


def numbered(items: Column, before: str, after: str) -> Column:
    """One line for each item: ``before``, its number from 1, ``after``, the item."""
    return F.array_join(F.transform(items, lambda x, i: F.concat(F.lit(before), (i + 1).cast("string"), F.lit(after), x)), "\n")


def quoted(x) -> Column:
    """A string as JSON."""
    return F.regexp_extract(F.to_json(F.struct(_c(x).alias("x"))), r'(?s)\A\{"x":(.*)\}\z', 1)


def fill(template: str, **values) -> Column:
    """``template`` with its ``{names}`` bound to columns or literals; unused values are ignored,
    doubled braces stand for single ones, an unbound name is an error."""
    import string

    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            v = values[name]
            parts.append(v.cast("string") if isinstance(v, Column) else F.lit(str(v)))
    return F.concat(*parts) if parts else F.lit("")


def next_year() -> Column:
    return F.year(F.current_date()) + 1


def merged(left: Column, right: Column) -> Column:
    """Two maps as one; where both have a key, the right one's value."""
    return F.map_concat(F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k)), right)


def capped(value: Column, most: int) -> Column:
    return F.least(F.ceil(value), F.lit(most))
