"""Raw invoice lines to clean transactions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from larder.config import HEADER_SPELLINGS, CleaningRules
from larder.functions.text import title_case, title_key

CANONICAL = (
    "invoice_no", "stock_code", "description", "quantity",
    "invoice_date", "unit_price", "customer_id", "country",
)


def _plain(name: str) -> str:
    return re.sub(r" ", "_", name.strip().lower())


def _header_map() -> dict[str, str]:
    """Normalised spelling -> canonical column name."""
    mapping = {}
    for target, spellings in zip(CANONICAL, HEADER_SPELLINGS.values()):
        for spelling in spellings:
            mapping[_plain(spelling)] = target
    return mapping


def canonical_names(df: DataFrame) -> DataFrame:
    """Trim, lower-case and underscore the headers, then apply the known spellings.

    A spelling is skipped when its canonical column is already present.
    """
    mapping = _header_map()
    plain = [_plain(c) for c in df.columns]
    taken = {c for c in plain if c in CANONICAL}
    names = []
    for name in plain:
        target = mapping.get(name, name)
        if target != name:
            if target in taken:
                target = name
            taken.add(target)
        names.append(target)
    return df.toDF(*names)


_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"


def number_of(df: DataFrame, name: str) -> Column:
    """A column as a double; text that is no plain number, and NaN, become null."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        # The cast alone would take suffixes such as 2d.
        value = F.when(F.trim(value).rlike(_NUMBER), F.trim(value))
    # nanvl works the number out once, where a condition on it and the number itself would twice.
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


_PATTERN = re.compile(r"'(?P<quoted>[^']*)'|(?P<run>(?P<letter>[A-Za-z])(?P=letter)*)|(?P<mark>.)", re.DOTALL)


def format_shape(fmt: str) -> str | None:
    """A regular expression that every text matches which the datetime pattern reads.

    Only patterns of plain numbers and fixed text have one; None for all others.
    """
    if "''" in fmt or re.search(r"[\[\]{}#]", fmt):
        return None
    shape = ""
    for part in _PATTERN.finditer(fmt):
        run = part["run"]
        if run is None:
            shape += re.escape(part["quoted"] if part["mark"] is None else part["mark"])
        elif run[0] in "ydHms" or run in ("M", "MM"):
            shape += r"[+-]?\d+"
        else:
            return None
    return f"(?iu)^{shape}$"


def time_of(df: DataFrame, rules: CleaningRules, name: str = "invoice_date") -> Column:
    """A column as a timestamp, by the first format that reads its text; null if none does.

    A format is only tried on text of its shape: a failed try raises inside, which
    costs far more than a match.
    """
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.DateType)):
        return F.col(name).cast("timestamp")
    text = F.trim(F.col(name))
    tries = []
    for fmt in rules.timestamp_formats:
        value, shape = F.try_to_timestamp(text, F.lit(fmt)), format_shape(fmt)
        tries.append(value if shape is None else F.when(text.rlike(shape), value))
    return F.coalesce(*tries)


def _rejections(raw: DataFrame, rules: CleaningRules) -> dict[str, Column]:
    """Why a line is left out, in order of precedence; each is true or false."""
    code = F.col("stock_code").cast("string")
    foreign = F.lit(False)
    if rules.country is not None and "country" in raw.columns:
        foreign = F.coalesce(F.col("country") != rules.country, F.lit(True))
    above_zero = lambda name: F.coalesce(number_of(raw, name) > 0, F.lit(False))
    return {
        "cancelled": F.coalesce(
            F.col("invoice_no").cast("string").startswith(rules.cancel_prefix), F.lit(False)
        ),
        "no_stock_code": code.isNull(),
        "not_a_product": F.coalesce(F.trim(code).isin(list(rules.excluded_codes)), F.lit(False)),
        "other_country": foreign,
        "unreadable_date": time_of(raw, rules).isNull(),
        "quantity_not_positive": ~above_zero("quantity"),
        "price_not_positive": ~above_zero("unit_price"),
    }


def rejected_lines(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Lines that cleaning leaves out, by the first rule that applies: ``reason, line_count``.

    Repeated lines are not among them. One pass; combined on the map side. All reasons
    are counted in one row: a filter on the reason would work it out a second time.
    """
    names = _rejections(raw, rules)
    reason = F.coalesce(*[F.when(c, F.lit(name)) for name, c in names.items()])
    counts = raw.select(reason.alias("reason")).agg(*[F.count_if(F.col("reason") == name).alias(name) for name in names])
    return counts.unpivot([], list(names), "reason", "line_count").where(F.col("line_count") > 0)


def _read_once(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``df`` with its columns replaced by ``values``, worked out once a row.

    A later filter on a plain projection is moved below it and works the values out
    again; it is not moved below a generator of one row.
    """
    made = {name: f"_read_{name}" for name in values}
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    read = df.select("*", F.inline(F.array(row)).alias(*made.values()))
    return read.withColumns({name: F.col(new) for name, new in made.items()}).drop(*made.values())


def clean_transactions(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Apply the cleaning rules and derive ``date`` and ``revenue``.

    Everything up to the row dedupe is narrow, so filters on typed columns reach the scan. Equal
    rows combine on the map side. Columns that follow from others (date,
    revenue, the letter case of the description) are added after the dedupe:
    they cannot change which rows are equal, the shuffle is smaller, and they
    cost nothing where they are not used.
    """
    code = F.col("stock_code").cast("string")
    invoice = F.col("invoice_no").cast("string")

    kept = raw.where(
        (invoice.isNull() | ~invoice.startswith(rules.cancel_prefix))
        & code.isNotNull()
        & ~F.trim(code).isin(list(rules.excluded_codes))
    )
    if rules.country is not None and "country" in raw.columns:
        kept = kept.where(F.col("country") == rules.country)

    values = {
        "invoice_date": time_of(raw, rules),
        "quantity": number_of(raw, "quantity"),
        "unit_price": number_of(raw, "unit_price"),
    }
    # Reading text is dear, so it is done once; filters on typed columns reach the scan.
    is_text = any(isinstance(raw.schema[name].dataType, T.StringType) for name in values)
    typed = (_read_once(kept, values) if is_text else kept.withColumns(values)).where(
        F.col("invoice_date").isNotNull() & (F.col("quantity") > 0) & (F.col("unit_price") > 0)
    )
    # A missing description turns into the text "Nan".
    name = F.trim(F.coalesce(F.col("description").cast("string"), F.lit("nan")))
    return (
        typed.withColumns({"stock_code": F.upper(F.trim(code)), "description": title_key(name)})
        .dropDuplicates()
        .withColumns(
            {
                "description": title_case(F.col("description")),
                "date": F.to_date("invoice_date"),
                "revenue": F.col("quantity") * F.col("unit_price"),
            }
        )
    )
