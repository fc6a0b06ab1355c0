"""Fixed column views of test, part and bin records."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of each view.
_TEST_VIEWS = {
    "PTR": "test_num head_num site_num result test_flg parm_flg test_txt alarm_id opt_flag res_scal llm_scal hlm_scal "
           "lo_limit hi_limit units c_resfmt c_llmfmt c_hlmfmt lo_spec hi_spec",
    "MPR": "test_num head_num site_num test_flg parm_flg rtn_icnt rslt_cnt test_txt alarm_id opt_flag res_scal llm_scal "
           "hlm_scal lo_limit hi_limit start_in incr_in rtn_stat rtn_rslt",
    "FTR": "test_num head_num site_num test_flg opt_flag cycl_cnt rel_vadr rept_cnt num_fail xfail_ad yfail_ad vect_nam "
           "time_set op_code test_txt alarm_id prog_txt rslt_txt patg_num spin_map",
}
_PART_VIEWS = {
    "PRR": "head_num site_num part_flg num_test hard_bin soft_bin x_coord y_coord test_t part_id part_txt part_fix",
    "HBR": "head_num site_num hbin_num hbin_cnt hbin_pf hbin_nam",
    "SBR": "head_num site_num sbin_num sbin_cnt sbin_pf sbin_nam",
}
_NUMERIC = {"test_num", "head_num", "site_num"}


def _view(records: DataFrame, record_type: str, names: str) -> DataFrame:
    def column(name: str) -> Column:
        text = F.col("fields")[name.upper()]
        if name in _NUMERIC:
            return F.coalesce(text.try_cast("bigint"), F.lit(0)).alias(name)
        return F.coalesce(text, F.lit("")).alias(name)

    rows = records.filter(F.col("record_type") == record_type)
    return rows.select("path", "record_index", "record_type", *[column(n) for n in names.split()])


def _union(records: DataFrame, views: dict[str, str]) -> DataFrame:
    frames = [_view(records, t, names) for t, names in views.items()]
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def flatten_tests(records: DataFrame) -> DataFrame:
    """PTR, MPR and FTR records (with a ``fields`` map) as one column view."""
    return _union(records, _TEST_VIEWS)


def flatten_parts(records: DataFrame) -> DataFrame:
    """PRR, HBR and SBR records as one column view."""
    return _union(records, _PART_VIEWS)
