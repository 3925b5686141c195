"""Channel/memo/remark and exchange rules written directly in pandas from
their description, compared with the Spark operators on sf0.001."""

import pandas as pd

from acctscreen.operators.cleansing import RAW_EXCHANGE_KEYS, filter_channel_memo, remove_exchanges
from acctscreen.sources import fixtures
from tests.conftest import SF001

CFG = fixtures.TEST_CONFIG


def _pandas_rules(pdf: pd.DataFrame) -> pd.DataFrame:
    keep = (pdf.channel_desc.isin(CFG.channels) & pdf.memo.isin(CFG.memos)
            & ~pdf.remk.isin(CFG.removed_remarks))          # NaN remark kept
    pdf = pdf[keep].copy()
    keys = list(RAW_EXCHANGE_KEYS)
    g = pdf.groupby(keys, dropna=True)                          # null keys form no group
    n_cur = g["cur"].agg(lambda s: len(pd.unique(s)))          # NaN counts as a value
    n_drcr = g["drcr"].agg(lambda s: len(pd.unique(s)))
    bad = set(n_cur[(n_cur > 1) & (n_drcr > 1)].index)
    mark = pdf[keys].apply(tuple, axis=1).isin(bad)
    return pdf[~mark]


def test_cleaning_rules_match_pandas(spark):
    t = fixtures.load(spark, SF001)
    pdf = t.savings_txn.toPandas()
    want = _pandas_rules(pdf)
    got = remove_exchanges(filter_channel_memo(t.savings_txn, CFG), RAW_EXCHANGE_KEYS)
    assert got.count() == len(want) == 2431
    key = ["acct_nbr_ori", "jrnl_no", "tx_amt", "cur", "drcr"]
    g = got.select(*key).toPandas().sort_values(key, na_position="first").reset_index(drop=True)
    w = want[key].sort_values(key, na_position="first").reset_index(drop=True)
    pd.testing.assert_frame_equal(g, w, check_dtype=False)
