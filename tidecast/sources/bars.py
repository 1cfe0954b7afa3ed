"""Price bars: file reader (S1), builder from raw trades (S4), symbol filter."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BARS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])


def _between(df: DataFrame, col: str, start, end) -> DataFrame:
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast(df.schema[col].dataType))
    if end is not None:
        df = df.where(F.col(col) < F.lit(end).cast(df.schema[col].dataType))
    return df


def read_bars(spark: SparkSession, path: str, symbols: Iterable[str] | None = None, start=None, end=None,
              schema: T.StructType = BARS_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """Daily bars of ``symbols`` with ``start <= date < end``.

    Explicit schema (no inference pass). The symbol and date predicates are
    plain column filters so they reach the scan: partition pruning when the
    files are laid out by ``symbol``, row-group skipping on ``date``.
    """
    df = spark.read.schema(schema).format(fmt).load(path)
    if symbols is not None:
        df = symbol_filter(df, symbols)
    return _between(df, "date", start, end)


def read_ticker_files(spark: SparkSession, folder: str, tickers: Iterable[str], start=None, end=None,
                      columns: T.StructType | None = None, suffix: str = ".csv", **options) -> DataFrame:
    """Daily bars from files as a price service delivers them, one per ticker and named after it.

    Only the files of ``tickers`` are listed and read; the symbol comes from a file's name. ``columns`` is the files'
    schema without the symbol (by default date, open, high, low, close, adjclose, volume with a header line), of which
    only the columns that are used are parsed. A missing file raises."""
    columns = columns or T.StructType([*[f for f in BARS_SCHEMA.fields if f.name not in ("symbol", "volume")],
                                       T.StructField("adjclose", T.DoubleType()), T.StructField("volume", T.LongType())])
    kind = suffix.split(".")[1]
    reader = spark.read.schema(columns).format(kind)
    reader = reader.options(**({"header": True, "enforceSchema": False} if kind == "csv" else {}), **options)
    df = reader.load([f"{folder.rstrip('/')}/{t}{suffix}" for t in tickers])
    # a file name in a path is percent-encoded
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    df = df.withColumn("symbol", F.left(name, F.length(name) - F.lit(len(suffix))))
    return _between(df.select("symbol", *columns.names), "date", start, end)


def read_trades(spark: SparkSession, path: str, ts: str, symbol: str, symbols: Iterable | None = None, start=None, end=None) -> DataFrame:
    """Raw trades of ``symbols`` with ``start <= ts < end``, as they were delivered: what bars are made from.

    Both predicates are on the files' own columns, so that they reach the scan; a filter on a bar's date would stop at
    the cast that makes it."""
    df = spark.read.parquet(path)
    if symbols is not None:
        df = symbol_filter(df, symbols, symbol)
    return _between(df, ts, start, end)


def symbol_filter(df: DataFrame, symbols, col: str = "symbol") -> DataFrame:
    """Keep one or several tickers."""
    if isinstance(symbols, (str, int)):
        return df.where(F.col(col) == F.lit(symbols))
    return df.where(F.col(col).isin(list(symbols)))


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pack_key(parts: Mapping[str, int | tuple[int, int]]) -> Column:
    """Several columns as one number that orders like them, NULL first: ``{"order_id": 40, "line": 8, "price": (40, 2)}``.

    ``parts`` gives each column's width in bits or, for decimal fractions kept as doubles, (bits, digits after the
    point). Whole numbers from 0 to 2 ** bits - 2 fit; any other value (negative, too large, with more digits) raises an
    error when it is met. Up to 63 bits make a bigint, up to 126 in two runs of at most 63 a decimal(38): both have a fixed width, so
    that aggregates ordered by the key stay hash aggregates, which a struct of the columns would not."""
    runs: list[list] = [[]]
    for c, width in parts.items():
        bits, digits = (width, None) if isinstance(width, int) else width
        if not 0 < bits <= 63:
            raise ValueError(f"{c}: a width is from 1 to 63 bits")
        if sum(b for _, b, _ in runs[-1]) + bits > 63:
            runs.append([])
        runs[-1].append((c, bits, digits))
    if len(runs) > 2:
        raise ValueError(f"{sum(b for r in runs for _, b, _ in r)} bits don't fit two runs of 63")
    fits, longs = F.lit(True), []
    for run in runs:
        packed = None
        for c, bits, digits in run:
            x = F.col(c)
            if digits is None:
                whole = x.cast("bigint")
            else:
                whole = F.round(x * 10**digits).cast("bigint")
                fits = fits & F.coalesce(whole / F.lit(float(10**digits)) == x, F.lit(True))
            fits = fits & F.coalesce((whole >= 0) & (whole < F.lit((1 << bits) - 1)), F.lit(True))
            part = F.coalesce(whole + 1, F.lit(0).cast("bigint"))
            packed = part if packed is None else F.shiftleft(packed, bits) + part
        longs.append(packed)
    if len(longs) == 1:
        key = longs[0]
    else:
        high, low = (x.cast("decimal(19,0)") for x in longs)
        key = (high * F.lit(str(1 << 63)).cast("decimal(19,0)") + low).cast("decimal(38,0)")
    bad = F.raise_error(F.concat(F.lit("tie columns don't fit their widths: "), F.to_json(F.struct(*parts)))).cast("boolean")
    return F.when(F.when(fits, F.lit(True)).otherwise(bad), key)


def make_bars(df: DataFrame, ts: str, price: str, tie: str | Sequence[str] | Mapping, symbol: str | None = None,
              unit: str = "day", volume: str | None = None, weekdays_only: bool = False,
              symbol_alias: str = "symbol", time_alias: str | None = None) -> DataFrame:
    """Open/high/low/close/volume bars from raw trades.

    Groups by (symbol, time bucket). ``open``/``close`` are the price of the
    first/last trade by ``tie`` (a column or a list of columns that make the
    order total; a mapping from columns to widths packs them, see ``pack_key``).
    ``volume`` is the trade count, or ``sum(volume)``.

    All five aggregates are declarative and merge partially, so each map task
    pre-aggregates its share of a hot symbol before the shuffle; a symbol that
    holds a third of the trades costs no more than its number of buckets.
    """
    if unit == "day":
        bucket = F.col(ts).cast("date")
    else:
        # date_trunc returns a session-zone timestamp; keep the input's type (e.g. timestamp_ntz)
        bucket = F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType)
    talias = time_alias or ("date" if unit == "day" else "ts")
    if weekdays_only:
        df = df.where(F.weekday(F.col(ts)) < 5)
    order_key = F.col(tie) if isinstance(tie, str) else pack_key(tie) if isinstance(tie, Mapping) else F.struct(*[F.col(t) for t in tie])
    keys = [bucket.alias(talias)]
    if symbol is not None:
        keys = [F.col(symbol).alias(symbol_alias), *keys]
    vol = F.count(F.lit(1)) if volume is None else F.sum(volume)
    p = F.col(price)
    return df.groupBy(*keys).agg(
        F.min_by(p, order_key).alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, order_key).alias("close"),
        vol.alias("volume"),
    )


def from_pandas(spark: SparkSession, pdf, schema: T.StructType | str | None = None, index_name: str = "date",
                reset_index: bool = True) -> DataFrame:
    """Local pandas frame to a Spark frame with its index as a column.

    A utility for tests and small inputs only: the data passes through the
    driver. Give ``schema`` to avoid inference (timestamps, missing values).
    A pandas NaN arrives as NULL when Arrow transfer is on and as NaN when it
    is off; every operator here treats both as missing.
    """
    if reset_index:
        pdf = pdf.reset_index()
        first = pdf.columns[0]
        if first in ("index", None) or first != index_name:
            pdf = pdf.rename(columns={first: index_name})
    return spark.createDataFrame(pdf, schema=schema)
