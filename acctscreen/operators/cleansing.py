"""Transaction cleaning: normalisation, channel/memo/remark rules, removal
of currency-exchange pairs, the currency filter and the payroll anti join.

Order matters (``clean``): tx_mode, then channel/memo/remark, then exchange
removal, then currency.  Exchange detection needs the foreign-currency leg,
so the currency filter must come last; a leg removed by the channel rule is
not seen by the exchange rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from acctscreen.config import ScreenConfig
from acctscreen.functions.datetime import epoch_to_datetime
from acctscreen.functions.predicates import cast_problem, differs_with_null, isin_keep_null, strict_cast
from acctscreen.operators.joins import distinct_join_keys
from acctscreen.sources.quarantine import Checked, set_aside

# Group of one booking: account, date-time and journal number.  After
# ``normalize_transactions`` the date-time is the single column ``tx_time``.
EXCHANGE_KEYS = ("acct_nbr_ori", "tx_time", "jrnl_no")
# The same groups on raw rows, where date and epoch time are separate.
RAW_EXCHANGE_KEYS = ("acct_nbr_ori", "tx_date", "tx_time", "jrnl_no")


def normalize_account(c, width: int = 14):
    """Account number text, trimmed and left-padded with zeros to ``width``
    characters (a longer value is kept whole, never cut)."""
    t = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.when(F.length(t) < width, F.lpad(t, width, "0")).otherwise(t)


def normalize_transactions(txn: DataFrame, cfg: ScreenConfig) -> DataFrame:
    """Typed, comparable transactions.

    * ``acct_nbr_ori`` zero-padded to the account width;
    * ``drcr`` -> int, ``pb_bal``/``tx_amt`` -> double, ``tx_date`` -> DATE;
      text that does not convert fails the job instead of turning into null,
      in any session.  A null stays null.  Rows that another filter removes
      before the cast is evaluated are not checked;
    * ``tx_time`` (epoch seconds) -> ``tx_date`` at the UTC clock time of
      the epoch value, as TIMESTAMP_NTZ (written as
      ``yyyy-MM-dd HH:mm:ss`` text by ``export_csv``);
    * only rows of the configured ``tx_mode``.
    """
    out = txn.withColumns(
        {
            "acct_nbr_ori": normalize_account("acct_nbr_ori", cfg.account_width),
            "drcr": strict_cast("drcr", "int", "drcr"),
            "pb_bal": strict_cast("pb_bal", "double", "pb_bal"),
            "tx_amt": strict_cast("tx_amt", "double", "tx_amt"),
            "tx_date": strict_cast("tx_date", "date", "tx_date"),
            "tx_time": epoch_to_datetime(strict_cast("tx_date", "date", "tx_date"), strict_cast("tx_time", "long", "tx_time")),
        }
    )
    if cfg.tx_mode is not None:
        out = out.filter(F.col("tx_mode") == cfg.tx_mode)
    return out


# The columns that ``normalize_transactions`` converts, and their types.
CONVERTED = {"drcr": "int", "pb_bal": "double", "tx_amt": "double", "tx_date": "date", "tx_time": "long"}


def normalize_checked(txn: DataFrame, cfg: ScreenConfig, path: str) -> Checked:
    """``normalize_transactions`` that sets rows with text that does not
    convert aside instead of stopping: one pass writes the typed rows and,
    apart from them, the rejected ones as they came, with every column at
    fault (``column=text``) in ``reasons``.  Good and rejected rows together
    are the rows of the configured ``tx_mode``."""
    if cfg.tx_mode is not None:
        txn = txn.filter(F.col("tx_mode") == cfg.tx_mode)
    reasons = F.array_compact(F.array(*[cast_problem(c, t, c) for c, t in CONVERTED.items()]))
    typed = {c: F.col(c).try_cast(t) for c, t in CONVERTED.items()}
    typed["acct_nbr_ori"] = normalize_account("acct_nbr_ori", cfg.account_width)
    typed["tx_time"] = epoch_to_datetime(typed["tx_date"], typed["tx_time"])
    good = {c: typed.get(c, F.col(c)) for c in txn.columns}
    return set_aside(txn, reasons, good, {c: F.col(c) for c in txn.columns}, path)


def filter_channel_memo(txn: DataFrame, cfg: ScreenConfig) -> DataFrame:
    """Allowed channel, allowed memo, and a remark not on the deny list
    (a null remark is kept; a null channel or memo is not)."""
    return txn.filter(
        F.col("channel_desc").isin(list(cfg.channels))
        & F.col("memo").isin(list(cfg.memos))
        & isin_keep_null("remk", cfg.removed_remarks)
    )


def _grouped(txn: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        txn = txn.filter(F.col(k).isNotNull())  # a null key forms no group
    return txn


def _exact_exchange_groups(txn: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rule on the values themselves.  Spark sorts for the least and
    greatest of a text (``SortAggregate``)."""
    groups = _grouped(txn, keys).groupBy(*keys).agg(
        differs_with_null("cur").alias("multi_cur"),
        differs_with_null("drcr").alias("multi_drcr"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return groups.filter(F.col("multi_cur") & F.col("multi_drcr")).select(*keys, "n_rows")


def text_code(c: Column) -> tuple[Column, Column]:
    """A number for a text, and whether no other text has it: up to seven bytes
    are the number's own digits (with their count), longer ones a hash below 0."""
    n = F.octet_length(c)
    short = F.conv(F.hex(c.cast("binary")), 16, 10).cast("long") * 8 + n
    long_ = F.xxhash64(c).bitwiseOR(F.lit(-(1 << 63)))
    return F.when(n == 0, F.lit(0)).when(n <= 7, short).otherwise(long_), n <= 7


def _code(txn: DataFrame, column: str, code: Callable[[Column], tuple[Column, Column]]) -> tuple[Column, Column]:
    c = F.col(column)
    whole = isinstance(txn.schema[column].dataType, IntegralType)
    return (c.cast("long"), F.lit(True)) if whole else code(c.cast("string"))


def exchange_groups(
    txn: DataFrame, keys: Sequence[str] = EXCHANGE_KEYS, store: Callable[[DataFrame], DataFrame] | None = None,
    code: Callable[[Column], tuple[Column, Column]] = text_code,
) -> DataFrame:
    """Booking groups that are currency exchanges: more than one currency
    and more than one debit/credit code, a null counting as a value.

    One partial hash aggregate over numbers that stand for the values
    (``text_code``): each task sends one row per group it saw, so even a group
    holding a large share of the rows costs little in the shuffle, and
    nothing is sorted.  Unequal numbers are unequal values.  Where equal
    numbers leave it open (texts of more than seven bytes), the group's rows,
    and only those, are compared by value.  ``store`` keeps the groups found
    by number; without it that second look is planned in any case."""
    coded, named = _grouped(txn, keys), {}
    for c in ("cur", "drcr"):
        number, own = _code(txn, c, code)
        coded = coded.withColumns({f"__{c}": number, f"__{c}_own": own})
        differs = differs_with_null(f"__{c}")
        open_ = ~differs & (F.count(f"__{c}") > 1) & F.coalesce(~F.bool_and(f"__{c}_own"), F.lit(False))
        named |= {f"{c}_differs": differs, f"{c}_open": open_}
    groups = coded.groupBy(*keys).agg(*[v.alias(k) for k, v in named.items()], F.count(F.lit(1)).alias("n_rows"))
    groups = groups.filter((F.col("cur_differs") | F.col("cur_open")) & (F.col("drcr_differs") | F.col("drcr_open")))
    groups = groups.select(*keys, "n_rows", (F.col("cur_differs") & F.col("drcr_differs")).alias("__sure"))
    groups = store(groups) if store else groups
    sure = groups.filter("__sure").select(*keys, "n_rows")
    unsure = groups.filter("not __sure")
    if store and unsure.isEmpty():
        return sure
    rows = txn.join(distinct_join_keys(unsure, keys), list(keys), "left_semi")
    return sure.unionByName(_exact_exchange_groups(rows, keys))


def remove_exchanges(txn: DataFrame, keys: Sequence[str] = EXCHANGE_KEYS, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Drop every row of an exchange group (``exchange_groups``).

    An equi anti join on the group key (null keys never match).  AQE
    broadcasts the group list when it is small; otherwise the list reaches
    the join through its own shuffle so that a hot booking group of the
    rows can be split over tasks (``distinct_join_keys``)."""
    groups = distinct_join_keys(exchange_groups(txn, keys, store), keys)
    return txn.join(groups, list(keys), "left_anti").select(*txn.columns)


def duplicate_time_keys(txn: DataFrame, keys: Sequence[str] = ("acct_nbr_ori", "tx_time")) -> DataFrame:
    """Account and date-time pairs booked more than once, with their row count."""
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    return (
        txn.filter(not_null)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def filter_currency(txn: DataFrame, currency: str = "TWD") -> DataFrame:
    """Only transactions in ``currency``."""
    return txn.filter(F.col("cur") == currency)


def exclude_payroll(txn: DataFrame, payroll: DataFrame) -> DataFrame:
    """Transactions of accounts not on the payroll list.  A list row with a
    null ``payroll_code`` does not exclude its account."""
    pay = payroll.filter(F.col("payroll_code").isNotNull()).select(
        F.col("acct_no_14").alias("acct_nbr_ori")
    )
    return txn.join(pay, "acct_nbr_ori", "left_anti").select(*txn.columns)


def clean(txn: DataFrame, cfg: ScreenConfig, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Normalise then apply the cleaning rules in their required order
    (``store``: see ``exchange_groups``)."""
    out = normalize_transactions(txn, cfg)
    out = filter_channel_memo(out, cfg)
    out = remove_exchanges(out, store=store)
    return filter_currency(out, cfg.currency)
