"""Column functions on strings. Each takes and returns a Column."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import fixed_values as V

# What counts as white space and as a word (letters, numbers, underscore).
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
          "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
BLANK_RUN = f"[{BLANKS}]+"
WORD = r"[\p{L}\p{N}_]+"
PYTHON_WORD = re.compile(r"\w+")  # the same words, for kernels that run in Python


def strip(c: Column) -> Column:
    """Remove white space at both ends (all Unicode white space, not only blanks)."""
    return F.btrim(c, F.lit(BLANKS))


def filled(c: Column) -> Column:
    """NULL for an empty string, so that coalesce skips it."""
    return F.nullif(c.cast("string"), F.lit(""))


def first_filled(*cols: Column, default: str | None = None) -> Column:
    parts = [filled(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def preview(c: Column, n: int = 220) -> Column:
    """The first n characters on one line."""
    return F.translate(F.substring(F.coalesce(c, F.lit("")), 1, n), "\n", " ")


def safe_preview(c: Column, n: int = 600) -> Column:
    """Tidy text for display: stripped, no carriage returns, at most one blank line in a row."""
    tidy = F.replace(strip(F.coalesce(c, F.lit(""))), F.lit("\r"), F.lit(""))
    tidy = F.regexp_replace(tidy, "\n{3,}", "\n\n")
    return F.when(F.length(tidy) > n, F.concat(F.substring(tidy, 1, n), F.lit("…"))).otherwise(tidy)


def ellipsis(c: Column, n: int = 200) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def normalize(c: Column) -> Column:
    """Lower case, stripped, every run of white space as one blank."""
    return F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), BLANK_RUN, " ")


def tokens(c: Column) -> Column:
    """Lower-cased word tokens, in order; none for NULL."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(WORD), F.lit(0))


def safe_name(c: Column) -> Column:
    """A name fit for files and tables."""
    cleaned = F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_")
    cleaned = F.regexp_replace(cleaned, r"\A_+|_+\z", "")
    return F.coalesce(filled(cleaned), F.lit("untitled"))


def suffix(path: Column) -> Column:
    """The lower-cased file suffix with its dot, or an empty string."""
    return F.lower(F.regexp_extract(path, r"\.[^./]+$", 0))


def stem(path: Column) -> Column:
    """The last path part without its suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def grandparent(path: Column) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-3))


def paragraphs_joined(c: Column) -> Column:
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), strip)
    return strip(F.array_join(F.filter(lines, lambda x: x != ""), "\n\n"))


def split_outside_parens(c: Column) -> Column:
    """Split a comma list, leaving commas inside parentheses alone."""
    return F.split(c, r",\s*(?![^()]*\))")


def data_url(path: Column, content: Column, mime: dict[str, str]) -> Column:
    """``data:<mime>;base64,<payload>``; an unlisted suffix is an error."""
    ext = suffix(path)
    kind = reduce(
        lambda case, item: case.when(ext == item[0], F.lit(item[1])),
        list(mime.items())[1:],
        F.when(ext == next(iter(mime)), F.lit(next(iter(mime.values())))),
    ).otherwise(F.raise_error(F.concat(F.lit("unsupported image type: "), ext)))
    payload = F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))  # Spark breaks lines at 76
    return F.concat(F.lit("data:"), kind, F.lit(";base64,"), payload)


def stable_id(*parts: Column) -> Column:
    """24 hex digits of sha256 over the parts joined by ``::`` (NULL reads as empty)."""
    joined = F.concat_ws("::", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.substring(F.sha2(joined, 256), 1, 24)


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders; NULL values read as empty.

    The template is cut here, so braces inside a value are never filled in turn.
    """
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[
        F.coalesce(values[part].cast("string"), F.lit("")) if i % 2 else F.lit(part)
        for i, part in enumerate(parts) if part])


def strip_echo(output: Column, prompt: Column) -> Column:
    """What a generator added after repeating its prompt."""
    return strip(F.substr(output, F.length(prompt) + 1))


def contains_any(c: Column, needles: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(n)) for n in needles])


def keyword_share(answer: Column, keywords: Column) -> Column:
    """Share of the keywords found as substrings of the lower-cased answer."""
    low = F.lower(F.coalesce(answer, F.lit("")))
    found = F.filter(keywords, lambda k: F.contains(low, k))
    return F.size(found) / F.nullif(F.size(keywords), F.lit(0))


def rubric_scores(text: Column, dimensions: list[str]) -> list[Column]:
    """One nullable DOUBLE per rubric dimension read from ``Name: 7.5`` lines."""
    return [
        F.regexp_extract(text, rf"(?i){d}:\s*([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double").alias(d.lower())
        for d in dimensions
    ]


def _number(text: Column) -> Column:
    """A plain decimal number, or NULL; type suffixes and names such as NaN are none."""
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def discount_text(c: Column) -> Column:
    """Read ``price,discount`` and state the final price with two decimals, or an error with its reason."""
    parts = F.split(c, ",")
    texts = [strip(F.get(parts, F.lit(i))) for i in (0, 1)]
    price, percent = (_number(t) for t in texts)
    final = price * (1 - percent / 100)
    # Prices that fit are rounded as decimals; beyond that a double has no cents left to round.
    shown = F.coalesce(F.round(final.try_cast("decimal(38,10)"), 2).cast("decimal(38,2)").cast("string"), F.format_string("%.2f", final))
    bad = F.when(price.isNull(), texts[0]).otherwise(texts[1])
    reason = F.when(F.size(parts) < 2, F.lit(V.DISCOUNT_FEW)).when(F.size(parts) > 2, F.lit(V.DISCOUNT_MANY)).otherwise(
        fill_template(V.DISCOUNT_WORD, {"value": bad}))
    good = (F.size(parts) == 2) & price.isNotNull() & percent.isNotNull()
    return F.when(good, fill_template(V.DISCOUNT_RESULT, {"percent": percent, "price": shown})).otherwise(
        fill_template(V.DISCOUNT_ERROR, {"reason": reason}))


def message_text(parts: Column) -> Column:
    """Join the non-empty text parts of a message."""
    texts = F.filter(F.transform(parts, lambda p: p["text"]), lambda t: F.coalesce(t, F.lit("")) != "")
    return strip(F.array_join(texts, "\n"))
