"""Registered queries over the driver tables and their DuckDB oracles.

One row per query: name, the Spark query (spark, sf_dir) -> DataFrame, and
the DuckDB SQL computing the same result (None: rows-only check).
"""

from __future__ import annotations

from starload.plans import checks_io as ci
from starload.plans import checks_ops as co
from starload.plans import checks_scalar as cs
from starload.plans import checks_stream as cst
from starload.plans import checks_warehouse as cw
from starload.plans import tpch

_TABLE = [
    ("sales_report", tpch.sales_report, tpch.SALES_REPORT_SQL),
    ("clean_text", cs.clean_text_check, cs.CLEAN_TEXT_SQL),
    ("clean_all_text", cs.clean_all_text_check, cs.CLEAN_ALL_TEXT_SQL),
    ("parse_number", cs.parse_number_check, cs.PARSE_NUMBER_SQL),
    ("parse_timestamp", cs.parse_timestamp_check, cs.PARSE_TIMESTAMP_SQL),
    ("parse_date", cs.parse_date_check, cs.PARSE_DATE_SQL),
    ("parse_date_report", cs.parse_date_report_check, cs.PARSE_DATE_REPORT_SQL),
    ("cast_int", cs.cast_int_check, cs.CAST_INT_SQL),
    ("try_int", cs.try_int_check, cs.TRY_INT_SQL),
    ("mixed_cells", cs.mixed_cells_check, cs.MIXED_CELLS_SQL),
    ("date_dimension", cs.date_dimension_check, cs.DATE_DIMENSION_SQL),
    ("generate_sales", cs.generate_sales_check, cs.GENERATE_SALES_SQL),
    ("expand_template", cs.expand_template_check, cs.EXPAND_TEMPLATE_SQL),
    ("left_lookup", co.left_lookup_check, co.LEFT_LOOKUP_SQL),
    ("composite_lookup", co.composite_lookup_check, co.COMPOSITE_LOOKUP_SQL),
    ("role_playing", co.role_playing_check, co.ROLE_PLAYING_SQL),
    ("scalar_lookup", co.scalar_lookup_check, co.SCALAR_LOOKUP_SQL),
    ("fk_orphans", co.fk_orphans_check, co.FK_ORPHANS_SQL),
    ("assign_keys", co.assign_keys_check, co.ASSIGN_KEYS_SQL),
    ("check_not_null", co.check_not_null_check, co.CHECK_NOT_NULL_SQL),
    ("profile", co.profile_check, co.PROFILE_SQL),
    ("row_count", co.row_count_check, co.ROW_COUNT_SQL),
    ("check_length", co.check_length_check, co.CHECK_LENGTH_SQL),
    ("check_unique", co.check_unique_check, co.CHECK_UNIQUE_SQL),
    ("check_foreign_key", co.check_foreign_key_check, co.CHECK_FOREIGN_KEY_SQL),
    ("check_decimal", co.check_decimal_check, co.CHECK_DECIMAL_SQL),
    ("filter_equals", co.filter_equals_check, co.FILTER_EQUALS_SQL),
    ("filter_is_true", co.filter_is_true_check, co.FILTER_IS_TRUE_SQL),
    ("between_days", co.between_days_check, co.BETWEEN_DAYS_SQL),
    ("contains_any", co.contains_any_check, co.CONTAINS_ANY_SQL),
    ("upsert_touch", co.upsert_touch_check, co.UPSERT_TOUCH_SQL),
    ("upsert_type1", co.upsert_type1_check, co.UPSERT_TYPE1_SQL),
    ("replace_range", co.replace_range_check, co.REPLACE_RANGE_SQL),
    ("replace_range_delete", co.replace_range_delete_check, co.REPLACE_RANGE_DELETE_SQL),
    ("replace_range_script", co.replace_range_script_check, co.REPLACE_RANGE_SCRIPT_SQL),
    ("plan_verdict", co.plan_verdict_check, co.PLAN_VERDICT_SQL),
    ("plan_report", co.plan_report_check, co.PLAN_REPORT_SQL),
    ("plan_report_sql", co.plan_report_sql_check, co.PLAN_REPORT_SQL),
    ("sql_scalar_function", co.sql_scalar_function_check, co.SQL_SCALAR_FUNCTION_SQL),
    ("table_function_filter", co.table_function_filter_check, co.TABLE_FILTER_SQL),
    ("dynamic_filter", co.dynamic_filter_check, co.TABLE_FILTER_SQL),
    ("read_delimited", ci.read_delimited_check, ci.READ_DELIMITED_SQL),
    ("read_glob", ci.read_glob_check, ci.READ_GLOB_SQL),
    ("export_split", ci.export_split_check, ci.EXPORT_SPLIT_SQL),
    ("read_rejects", ci.read_rejects_check, ci.READ_REJECTS_SQL),
    ("read_records", ci.read_records_check, ci.READ_RECORDS_SQL),
    ("export_exact", ci.export_exact_check, ci.EXPORT_EXACT_SQL),
    ("read_first_column", ci.read_first_column_check, ci.READ_FIRST_COLUMN_SQL),
    ("foreign_table", ci.foreign_table_check, ci.FOREIGN_TABLE_SQL),
    ("append_table", ci.append_table_check, ci.APPEND_TABLE_SQL),
    ("replace_table", ci.replace_table_check, ci.REPLACE_TABLE_SQL),
    ("export_csv", ci.export_csv_check, ci.EXPORT_CSV_SQL),
    ("bulk_load", ci.bulk_load_check, ci.BULK_LOAD_SQL),
    ("bulk_load_one_file", ci.bulk_load_one_file_check, ci.BULK_LOAD_SQL),
    ("resolve_facts", cw.resolve_facts_check, cw.RESOLVE_FACTS_SQL),
    ("resolve_facts_hot", cw.resolve_facts_hot_check, cw.RESOLVE_FACTS_HOT_SQL),
    ("report_of_sums", cw.report_of_sums_check, cw.STAGE_UPDATE_REPORT_SQL),
    ("initial_load", cw.initial_load_check, cw.INITIAL_LOAD_SQL),
    ("stage_report", cw.stage_report_check, cw.STAGE_REPORT_SQL),
    ("union_all", cw.union_all_check, cw.UNION_ALL_SQL),
    ("top_n_report", cw.top_n_report_check, cw.TOP_N_REPORT_SQL),
    ("report_view", cw.report_view_check, cw.REPORT_VIEW_SQL),
    ("ingest_chunks", cst.ingest_chunks_check, cst.INGEST_CHUNKS_SQL),
    ("ingest_rows", cst.ingest_rows_check, cst.INGEST_CHUNKS_SQL),
    ("batch_ids", cst.batch_ids_check, cst.BATCH_IDS_SQL),
    ("chunk_batches", cst.chunk_batches_check, cst.CHUNK_BATCHES_SQL),
    ("stage_update_dims", cw.stage_update_dims_check, cw.STAGE_UPDATE_DIMS_SQL),
    ("stage_update_report", cw.stage_update_report_check, cw.STAGE_UPDATE_REPORT_SQL),
    ("cleanse_exports", cw.cleanse_exports_check, cw.CLEANSE_EXPORTS_SQL),
    ("many_file_ingest", cw.many_file_ingest_check, cw.MANY_FILE_INGEST_SQL),
    ("project_columns", cw.project_columns_check, cw.PROJECT_COLUMNS_SQL),
    ("rename_positional", cw.rename_positional_check, cw.RENAME_POSITIONAL_SQL),
    ("typed_table", ci.typed_table_check, ci.TYPED_TABLE_SQL),
    ("truncate_reload", ci.truncate_reload_check, ci.APPEND_TABLE_SQL),
    ("create_table_as", ci.create_table_as_check, cs.DATE_DIMENSION_SQL),
]

QUERIES = {name: query for name, query, _ in _TABLE}
ORACLES = {name: sql for name, _, sql in _TABLE if sql is not None}
