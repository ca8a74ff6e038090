"""Generated by scripts/gen_decimal_columns.py: DECIMAL and DATE/TIMESTAMP
output columns per query."""

DECIMAL_COLUMNS = {'analysis_footer': [],
 'avg_clv_by_segment': [],
 'cac_reduction': ['total_incremental_revenue'],
 'campaign_cost_by_segment': [],
 'campaign_preview': ['projected_clv_12m'],
 'campaign_roi': ['total_expected'],
 'campaign_targets': [],
 'category_distribution': [],
 'category_net_revenue_top9': ['net_revenue', 'margin_pct'],
 'category_revenue': ['blended_margin_pct', 'gross_revenue', 'net_revenue'],
 'clean_lines': ['unit_price'],
 'cleaning_waterfall': [],
 'clv_histogram': [],
 'clv_overall': ['total_projected_12m', 'min_clv_12m', 'max_clv_12m'],
 'clv_scores': ['avg_order_value',
                'purchase_freq_monthly',
                'churn_rate',
                'gross_margin_pct',
                'clv_12m',
                'clv_36m'],
 'clv_scores_notebook': [],
 'clv_segment_validation': ['total_projected_12m'],
 'clv_stats': [],
 'cohort_retention': [],
 'constraint_violations': [],
 'country_customers_top10': [],
 'country_revenue': ['gross_revenue', 'total_clv_12m'],
 'country_revenue_line_grain': ['gross_revenue', 'total_clv_12m'],
 'customer_clv_master': ['monetary'],
 'customer_master': ['historical_revenue',
                     'avg_order_value',
                     'monthly_purchase_freq',
                     'gross_margin_pct',
                     'churn_rate',
                     'clv_12m',
                     'clv_36m'],
 'customer_reach': ['gross_revenue'],
 'customers_dim': [],
 'dataset_span_months': [],
 'monthly_kpi': ['gross_revenue', 'net_revenue', 'total_profit'],
 'monthly_net_revenue': ['net_revenue'],
 'monthly_revenue': ['gross_revenue'],
 'order_details': ['unit_price', 'line_total', 'line_profit'],
 'order_heatmap': [],
 'order_items': ['unit_price', 'line_total'],
 'order_items_enriched': ['unit_price', 'line_total', 'net_line_total', 'line_profit'],
 'orders_dim': [],
 'products_dim': ['avg_unit_price'],
 'quality_audit': [],
 'raw_staging': ['UnitPrice'],
 'rfm_clv_points': ['monetary'],
 'rfm_describe': [],
 'rfm_score_distribution': [],
 'rfm_scores': ['monetary'],
 'rfm_scores_notebook': ['monetary'],
 'rfm_segment_validation': ['total_revenue'],
 'score_upsert': ['monetary'],
 'segment_counts': [],
 'segment_kpi': ['total_projected_clv_12m'],
 'segment_matrix': ['total_projected_12m'],
 'snapshot_date': [],
 'staging_counts': [],
 'table_counts': [],
 'top_customers_clv': ['total_revenue',
                       'avg_order_value',
                       'projected_clv_12m',
                       'projected_clv_36m'],
 'top_products': ['net_revenue']}

TEMPORAL_COLUMNS = {'analysis_footer': [],
 'avg_clv_by_segment': [],
 'cac_reduction': [],
 'campaign_cost_by_segment': [],
 'campaign_preview': [],
 'campaign_roi': [],
 'campaign_targets': [],
 'category_distribution': [],
 'category_net_revenue_top9': [],
 'category_revenue': [],
 'clean_lines': ['invoice_date'],
 'cleaning_waterfall': [],
 'clv_histogram': [],
 'clv_overall': [],
 'clv_scores': [],
 'clv_scores_notebook': [],
 'clv_segment_validation': [],
 'clv_stats': [],
 'cohort_retention': [],
 'constraint_violations': [],
 'country_customers_top10': [],
 'country_revenue': [],
 'country_revenue_line_grain': [],
 'customer_clv_master': ['first_purchase_date', 'last_purchase_date'],
 'customer_master': ['first_purchase_date', 'last_purchase_date'],
 'customer_reach': [],
 'customers_dim': ['first_purchase_date', 'last_purchase_date'],
 'dataset_span_months': [],
 'monthly_kpi': [],
 'monthly_net_revenue': ['order_date'],
 'monthly_revenue': [],
 'order_details': ['order_date'],
 'order_heatmap': [],
 'order_items': [],
 'order_items_enriched': ['order_date'],
 'orders_dim': ['invoice_date'],
 'products_dim': [],
 'quality_audit': [],
 'raw_staging': ['InvoiceDate'],
 'rfm_clv_points': [],
 'rfm_describe': [],
 'rfm_score_distribution': [],
 'rfm_scores': [],
 'rfm_scores_notebook': [],
 'rfm_segment_validation': [],
 'score_upsert': [],
 'segment_counts': [],
 'segment_kpi': [],
 'segment_matrix': [],
 'snapshot_date': ['snapshot_date'],
 'staging_counts': [],
 'table_counts': [],
 'top_customers_clv': [],
 'top_products': []}
