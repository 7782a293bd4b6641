"""

A value names registered queries, or a test as file::function.
"""

COVERAGE: dict[str, tuple[str, ...]] = {
    # scans, sources, sinks, catalog
    "S1": ("test_clean.py::test_malformed_fields_become_null_and_are_reported", "s1_f1_csv_lines"),
    "S2": ("test_clean.py::test_inferred_types", "s2_inferred_lines"),
    "S3": ("test_clean.py::test_external_table_skips_the_header", "s3_external_lines"),
    "S4": ("test_runs.py::test_warehouse_tables_are_created_once", "s4_s5_warehouse_countries"),
    "S5": ("test_runs.py::test_warehouse_tables_are_created_once", "s4_s5_warehouse_countries", "s5_bucketed_invoices"),
    "S6": ("test_runs.py::test_fact_is_read_by_partition", "s7_replaced_result"),
    "S7": ("test_runs.py::test_ledger_run_writes_every_result", "s7_replaced_result"),
    "S8": ("test_runs.py::test_dashboard_reads", "v1_written_overview", "v5_written_months", "v4_written_products", "v6_written_countries", "v7_written_segments"),
    "S9": ("test_runs.py::test_warehouse_tables_are_created_once", "s9_warehouse_view"),
    "S10": ("test_runs.py::test_missing_store_folder_has_no_results", "s10_warehouse_tables"),
    "S11": ("test_runs.py::test_ledger_run_writes_every_result",),
    "S12": ("test_views.py::test_last_rows_are_returned_in_ascending_order", "s12_preview"),
    "S13": ("s13_run_summary", "s13_written_summary"),
    # projections, filters, predicates
    "P1": ("d2_ledger_lines",),
    "P2": ("d1_merge_repeats",),
    "P3": ("d1_merge_repeats",),
    "P4": ("c7_shopper_segments",),
    "P5": ("d4_shopper_lines",),
    "P6": ("d5_basket_lines",),
    "P7": ("d5_basket_lines",),
    "P8": ("b1_baskets",),
    "P9": ("v2_segment_page",),
    "P10": ("p10_find_customer",),
    "P11": ("d4_shopper_lines",),
    "P12": ("c7_shopper_segments", "r3_weekday_by_lines"),
    "P13": ("c1_rfm_by_lines",),
    # joins and subqueries
    "J1": ("j1_with_key_totals",),
    "J2": ("b5_item_pairs", "b6_product_rules"),
    "J3": ("b7_brand_line_pairs", "b7_part_line_pairs"),
    "J4": ("c1_rfm_by_lines", "c3_rfm_by_invoices"),
    "J5": ("b5_item_pairs",),
    "J6": ("c3_rfm_by_invoices",),
    # aggregations
    "A1": ("r15_invoice_transactions",),
    "A2": ("r16_overview",),
    "A3": ("r1_monthly_by_lines",),
    "A4": ("r2_monthly_by_invoices", "r16_overview", "a4_sketched_months", "a4_sketched_countries"),
    "A5": ("r1_monthly_by_lines",),
    "A6": ("r1_monthly_by_lines", "r8_top_by_revenue"),
    "A7": ("r16_overview", "c5_shopper_base"),
    "A8": ("b2_product_dimension",),
    "A9": ("b1_baskets",),
    "A10": ("r18_repeat_purchases", "c5_shopper_base"),
    "A11": ("r12_countries_by_invoices", "r18_repeat_purchases"),
    "A12": ("b5_item_pairs",),
    "A13": ("v7_segment_counts",),
    "A14": ("v1_overview", "v2_page_count"),
    "A15": ("v10_largest_by_hour", "v10_largest_summary"),
    # windows
    "W1": ("w1_first_line_per_key",),
    "W2": ("c1_rfm_by_lines", "c6_shopper_scores"),
    "W3": ("c3_rfm_by_invoices",),
    "W4": ("r14_monthly_trend",),
    "W5": ("v6_countries", "v7_segment_counts"),
    "W6": ("v5_monthly",),
    "W7": ("v4_products_by_revenue", "v9_transactions_largest", "w7_invoice_positions"),
    # sorts, limits, paging
    "L1": ("test_views.py::test_months_show_their_direction", "l1_countries_in_order"),
    "L2": ("r7_top_by_quantity", "r17_top_spenders"),
    "L3": ("v9_transactions_largest", "v9_transactions_smallest"),
    "L4": ("v2_customers_page", "v2_segment_page"),
    "L5": ("v2_page_count", "v9_page_count"),
    "L6": ("v13_customers", "v1_front_products"),
    "L7": ("v5_weekdays",),
    "L8": ("v2_segments",),
    "L9": ("v13_top_countries",),
    # scalar functions
    "F1": ("test_columns.py::test_times_that_do_not_fit_the_layout_are_null", "s1_f1_csv_lines"),
    "F2": ("test_columns.py::test_times_that_do_not_fit_the_layout_are_null", "f2_us_dates"),
    "F3": ("d2_ledger_lines",),
    "F4": ("d2_ledger_lines",),
    "F5": ("c3_rfm_by_invoices",),
    "F6": ("c1_rfm_by_lines",),
    "F7": ("r3_weekday_by_lines", "r4_weekday_by_invoices"),
    "F8": ("r1_monthly_by_lines",),
    "F9": ("d2_ledger_lines", "d4_shopper_lines"),
    "F10": ("d2_ledger_lines",),
    "F11": ("d2_ledger_lines",),
    "F12": ("c3_rfm_by_invoices",),
    "F13": ("c6_shopper_scores",),
    "F14": ("d5_basket_lines",),
    "F15": ("x7_product_codes_only",),
    "F16": ("b5_item_pairs",),
    "F17": ("d4_shopper_lines",),
    "F18": ("v4_products_by_revenue",),
    "F19": ("v5_monthly", "v5_hours_v12_busy"),
    "F20": ("v5_monthly",),
    "F21": ("v2_customers_page",),
    # cleaning, reports, quality
    "D1": ("d1_merge_repeats",),
    "D2": ("d2_ledger_lines",),
    "D3": ("d3_member_lines",),
    "D4": ("d4_shopper_lines",),
    "D5": ("d5_basket_lines",),
    "R1": ("r1_monthly_by_lines",),
    "R2": ("r2_monthly_by_invoices",),
    "R3": ("r3_weekday_by_lines",),
    "R4": ("r4_weekday_by_invoices",),
    "R5": ("r5_hourly_by_lines",),
    "R6": ("r6_hourly_by_invoices",),
    "R7": ("r7_top_by_quantity",),
    "R8": ("r8_top_by_revenue",),
    "R9": ("r9_top_codes_by_quantity",),
    "R10": ("r10_top_codes_by_revenue",),
    "R11": ("r11_countries_by_lines",),
    "R12": ("r12_countries_by_invoices",),
    "R13": ("r13_monthly_totals",),
    "R14": ("r14_monthly_trend",),
    "R15": ("r15_invoice_transactions",),
    "R16": ("r16_overview",),
    "R17": ("r17_top_spenders",),
    "R18": ("r18_repeat_purchases",),
    "R19": ("test_runs.py::test_ledger_run_writes_every_result", "r19_ledger_run", "r19_text_ledger_run"),
    "Q1": ("q1_null_counts",),
    "Q2": ("q2_lines_without_customer",),
    "Q3": ("q3_suspicious_counts",),
    "Q4": ("q4_removal_report",),
    "Q5": ("q5_rule_violations",),
    # customers
    "C1": ("c1_rfm_by_lines",),
    "C2": ("c2_segment_statistics",),
    "C3": ("c3_rfm_by_invoices",),
    "C4": ("c4_segment_statistics_by_value",),
    "C5": ("c5_shopper_base",),
    "C6": ("c6_shopper_scores",),
    "C7": ("c7_shopper_segments",),
    "C8": ("c8_cluster_statistics",),
    "C9": ("test_runs.py::test_segments_cover_all_customers", "c9_segmentation_run"),
    # baskets
    "B1": ("b1_baskets", "b1_wide_baskets"),
    "B2": ("b2_product_dimension",),
    "B3": ("b3_frequent_itemsets", "b3_part_itemsets"),
    "B4": ("b4_association_rules",),
    "B5": ("b5_item_pairs", "b5_part_pairs"),
    "B6": ("b6_product_rules",),
    "B7": ("b7_brand_line_pairs", "b7_part_line_pairs"),
    "B8": ("test_runs.py::test_recommendations_are_sane", "b8_recommendation_run"),
    # dashboard reads
    "V1": ("v1_overview", "v1_front_products", "v1_written_overview"),
    "V2": ("v2_customers_page", "v2_segment_page", "v2_page_count", "v2_segments", "v2_written_page"),
    "V3": ("v3_customer_details", "p10_find_customer"),
    "V4": ("v4_products_by_revenue", "v4_products_by_quantity"),
    "V5": ("v5_monthly", "v5_weekdays", "v5_hours_v12_busy"),
    "V6": ("v6_countries", "v6_country_totals"),
    "V7": ("v7_segment_counts", "v7_segment_statistics", "v1_written_split"),
    "V8": ("v8_pairs", "v8_rules"),
    "V9": ("v9_transactions_largest", "v9_transactions_smallest", "v9_page_count", "v9_written_page"),
    "V10": ("v10_largest_by_hour", "v10_largest_summary"),
    "V11": ("v11_hour_histogram",),
    "V12": ("v5_hours_v12_busy",),
    "V13": ("v13_customers", "v13_top_countries"),
    "V14": ("v14_segment_notes",),
    # documented operators
    "X1": ("x1_quarterly",),
    "X2": ("x2_top_by_orders",),
    "X3": ("x3_standardised",),
    "X4": ("x4_elbow", "x4_elbow_k"),
    "X5": ("x5_cluster_profile",),
    "X6": ("x6_documented_segments",),
    "X7": ("x7_product_codes_only",),
    "X8": ("x8_without_exact_copies",),
    "X9": ("x9_customers_per_region", "x9_markets_abroad"),
}
