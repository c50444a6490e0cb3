"""Double-typed output columns per query (generated by tools/compare.py --gen-doubles)."""

DOUBLE_COLUMNS = {
    'stg_orders': [],
    'stg_customers': [],
    'stg_sellers': [],
    'stg_products': ['product_weight_g', 'product_length_cm', 'product_height_cm', 'product_width_cm', 'product_volume_cm3'],
    'stg_order_items': ['price', 'freight_value'],
    'stg_order_payments': ['payment_value'],
    'stg_order_reviews': [],
    'stg_geolocation_zip': ['latitude', 'longitude'],
    'int_order_items_agg': ['gmv', 'freight_value', 'total_weight_g', 'total_volume_cm3'],
    'int_order_payments_agg': ['payment_value', 'voucher_value'],
    'int_order_reviews_latest': [],
    'int_order_distance': ['customer_lat', 'customer_lng', 'seller_lat', 'seller_lng', 'distance_km'],
    'dim_customers': ['customer_lat', 'customer_lng'],
    'dim_sellers': ['seller_lat', 'seller_lng', 'lifetime_gmv'],
    'dim_products': ['product_weight_g', 'product_length_cm', 'product_height_cm', 'product_width_cm', 'product_volume_cm3'],
    'dim_regions': [],
    'dim_dates': [],
    'fct_orders': ['approval_hours', 'handling_days', 'transit_days', 'delivery_days', 'estimated_days', 'delivery_delay_days', 'carrier_handover_delay_days', 'gmv', 'freight_value', 'total_weight_g', 'payment_value', 'distance_km', 'take_revenue', 'freight_revenue', 'delivery_cost', 'payment_fee', 'handling_cost', 'platform_revenue', 'platform_cost', 'contribution_margin', 'cost_per_delivery'],
    'fct_order_items': ['price', 'freight_value', 'freight_ratio', 'product_weight_g', 'product_volume_cm3', 'delivery_days'],
    'mart_kpi_daily_region': ['on_time_rate', 'avg_delivery_days', 'avg_delivery_delay_days', 'avg_estimated_days', 'avg_review_score', 'gmv', 'freight_revenue', 'take_revenue', 'platform_revenue', 'delivery_cost', 'payment_fees', 'handling_cost', 'platform_cost', 'contribution_margin', 'margin_per_order', 'avg_order_value', 'cost_per_delivery', 'freight_to_gmv_ratio'],
    'mart_unit_economics_monthly': ['gmv', 'take_revenue', 'freight_revenue', 'platform_revenue', 'delivery_cost', 'payment_fees', 'handling_cost', 'platform_cost', 'contribution_margin', 'avg_order_value', 'items_per_order', 'revenue_per_order', 'cost_per_order', 'margin_per_order', 'contribution_margin_pct', 'cost_per_delivery', 'freight_to_gmv_ratio', 'on_time_rate', 'avg_delivery_days'],
    'mart_demand_weekly_region': ['gmv', 'freight_value'],
    'mart_delivery_time_weekly_region': ['avg_delivery_days', 'median_delivery_days', 'avg_transit_days', 'avg_handling_days', 'avg_estimated_days', 'avg_delivery_delay_days', 'avg_distance_km', 'on_time_rate'],
    'mart_seller_performance': ['gmv', 'freight_value', 'avg_order_gmv', 'on_time_rate', 'avg_delivery_days', 'avg_handling_days', 'avg_review_score'],
    'mart_category_monthly': ['gmv', 'freight_value', 'avg_item_price', 'freight_to_gmv_ratio', 'on_time_rate', 'avg_delivery_days', 'avg_review_score'],
    'dash_headline': ['on_time_rate', 'margin_per_order', 'cost_per_delivery', 'gmv', 'delivery_cost', 'contribution_margin'],
    'dash_weekly_service': ['on_time_rate', 'avg_delivery_days'],
    'dash_monthly_unit_economics': ['margin_per_order', 'cost_per_delivery', 'revenue_per_order', 'cost_per_order', 'avg_order_value'],
    'dash_state_scorecard': ['on_time_rate', 'avg_delivery_days', 'margin_per_order', 'cost_per_delivery', 'avg_order_value'],
    'dash_cost_mix': ['delivery_cost', 'payment_fees', 'handling_cost'],
    'kpi_measures': ['gmv', 'on_time_rate', 'avg_delivery_days', 'contribution_margin', 'margin_per_order', 'cost_per_delivery', 'avg_order_value', 'freight_to_gmv', 'contribution_margin_pct'],
    'kpi_prior_year': ['on_time_rate', 'margin_per_order', 'on_time_rate_py', 'margin_per_order_py', 'margin_per_order_delta_py'],
    'kpi_previous_period': ['gmv', 'on_time_rate', 'avg_delivery_days', 'contribution_margin', 'margin_per_order', 'cost_per_delivery', 'avg_order_value', 'freight_to_gmv', 'contribution_margin_pct'],
    'dq_suite': [],
    'dq_unique': [],
    'dq_not_null': [],
    'dq_accepted_values': [],
    'dq_relationships': [],
    'dq_non_negative': ['value'],
    'dq_between': ['value'],
    'dq_row_count_matches': [],
    'dq_unique_combination': [],
    'dq_margin_components': [],
    'dq_delivered_timestamp': [],
    'dq_kpi_reconcile': [],
    'panel_demand': ['value', 'volume'],
    'panel_delivery': ['value', 'volume'],
    'trim_incomplete_tail': ['value', 'volume'],
    'censor_tail': ['value', 'volume'],
    'complete_weeks_demand': ['value', 'volume'],
    'complete_weeks_delivery': ['value', 'volume'],
    'rolling_origin_folds': [],
    'rolling_origin_folds_delivery': [],
    'candidate_models': [],
    'candidate_models_delivery': [],
    'model_pooled_gbm': ['forecast', 'actual'],
    'model_pooled_gbm_delivery': ['forecast', 'actual'],
    'model_moving_average': ['forecast', 'actual'],
    'model_moving_average_delivery': ['forecast', 'actual'],
    'model_seasonal_naive': ['forecast', 'actual'],
    'model_seasonal_naive_delivery': ['forecast', 'actual'],
    'model_holt_damped': ['forecast', 'actual'],
    'model_holt_damped_delivery': ['forecast', 'actual'],
    'backtest_univariate': ['forecast', 'actual'],
    'backtest_univariate_delivery': ['forecast', 'actual'],
    'metrics_by_model': ['mae', 'smape', 'wape', 'bias'],
    'metrics_by_model_delivery': ['mae', 'smape', 'wape', 'bias'],
    'residual_quantiles': ['q_lo', 'q_hi'],
    'residual_quantiles_delivery': ['q_lo', 'q_hi'],
    'champion_models': ['backtest_wape'],
    'champion_models_delivery': ['backtest_wape'],
    'pooled_features': ['target', 'woy_sin', 'woy_cos', 'level_4', 'level_8', 'lag_1', 'lag_2', 'lag_3', 'lag_4', 'lag_6', 'lag_8'],
    'pooled_features_delivery': ['target', 'woy_sin', 'woy_cos', 'level_4', 'level_8', 'lag_1', 'lag_2', 'lag_3', 'lag_4', 'lag_6', 'lag_8', 'exog_log_volume'],
    'forecast_accuracy': ['mae', 'smape', 'wape', 'bias'],
    'uni_forecast_accuracy': ['mae', 'smape', 'wape', 'bias'],
    'forecast_publish': ['forecast', 'forecast_lower', 'forecast_upper', 'backtest_wape'],
    'uni_forecast_publish': ['forecast', 'forecast_lower', 'forecast_upper', 'backtest_wape'],
    'forecast_publish_delivery': ['forecast', 'forecast_lower', 'forecast_upper', 'backtest_wape'],
    'uni_forecast_publish_delivery': ['forecast', 'forecast_lower', 'forecast_upper', 'backtest_wape'],
    'forecast_runs': ['median_champion_wape', 'country_champion_wape'],
    'uni_forecast_runs': ['median_champion_wape', 'country_champion_wape'],
    'mart_forecast_vs_actual': ['forecast', 'forecast_lower', 'forecast_upper', 'backtest_wape', 'actual', 'error', 'abs_error', 'abs_pct_error'],
    'uni_mart_forecast_vs_actual': ['forecast', 'forecast_lower', 'forecast_upper', 'backtest_wape', 'actual', 'error', 'abs_error', 'abs_pct_error'],
    'mart_forecast_accuracy_latest': ['mae', 'smape', 'wape', 'bias'],
    'uni_mart_forecast_accuracy_latest': ['mae', 'smape', 'wape', 'bias'],
    'dash_demand_actual_vs_forecast': ['orders', 'forecast', 'forecast_lower', 'forecast_upper'],
    'uni_dash_demand_actual_vs_forecast': ['orders', 'forecast', 'forecast_lower', 'forecast_upper'],
    'dash_demand_chart': ['orders', 'forecast', 'forecast_lower', 'forecast_upper'],
    'uni_dash_demand_chart': ['orders', 'forecast', 'forecast_lower', 'forecast_upper'],
    'dash_forecast_accuracy': ['wape', 'smape', 'bias'],
    'uni_dash_forecast_accuracy': ['wape', 'smape', 'bias'],
    'dash_forecast_series': ['actual', 'forecast', 'forecast_lower', 'forecast_upper'],
    'uni_dash_forecast_series': ['actual', 'forecast', 'forecast_lower', 'forecast_upper'],
    'dash_accuracy_drilldown': ['wape', 'smape', 'bias'],
    'uni_dash_accuracy_drilldown': ['wape', 'smape', 'bias'],
    'realised_wape': ['realised_wape', 'forecast_orders', 'actual_orders'],
    'uni_realised_wape': ['realised_wape', 'forecast_orders', 'actual_orders'],
    'champion_backtest_wape': ['champion_backtest_wape'],
    'uni_champion_backtest_wape': ['champion_backtest_wape'],
    'log_sql_normalise': [],
    'log_sql_tables': [],
    'log_sql_audit': [],
    'log_grounding': [],
    'log_tool_budget': [],
    'log_history_trim': [],
    'log_strip_mentions': [],
    'log_usage_totals': [],
    'log_history_marks': [],
    'scan_csv_typed': [],
    'scan_csv_customers': [],
    'scan_csv_geolocation': ['geolocation_lat', 'geolocation_lng'],
    'scan_csv_order_items': ['price', 'freight_value'],
    'scan_csv_order_payments': ['payment_value'],
    'scan_csv_order_reviews': [],
    'scan_csv_products': ['product_weight_g', 'product_length_cm', 'product_height_cm', 'product_width_cm'],
    'scan_csv_sellers': [],
    'scan_csv_category_translation': [],
    'scan_header_check': [],
    'load_row_counts': [],
    'materialize_mart': ['on_time_rate', 'avg_delivery_days', 'avg_delivery_delay_days', 'avg_estimated_days', 'avg_review_score', 'gmv', 'freight_revenue', 'take_revenue', 'platform_revenue', 'delivery_cost', 'payment_fees', 'handling_cost', 'platform_cost', 'contribution_margin', 'margin_per_order', 'avg_order_value', 'cost_per_delivery', 'freight_to_gmv_ratio'],
    'forecast_append_runs': ['median_champion_wape', 'country_champion_wape'],
    'uni_append_runs': ['median_champion_wape', 'country_champion_wape'],
    'uni_append_counts': [],
    'catalog_tables': [],
    'catalog_columns': [],
    'bounded_query': ['avg_days'],
    'bounded_query_truncated': [],
    'rows_to_json': [],
    'agg_approx_median': ['median_delivery_days_approx'],
    'model_custom_pandas': ['forecast'],
    'dq_probe_suite': [],
    'dq_probe_unique': [],
    'dq_probe_not_null': [],
    'dq_probe_accepted_values': [],
    'dq_probe_relationships': [],
    'dq_probe_row_count_matches': [],
    'dq_probe_unique_combination': [],
    'dq_probe_margin_components': [],
    'dq_probe_delivered_timestamp': [],
    'dq_probe_kpi_reconcile': [],
    'uni_dq_forecast_marts': [],
    'dq_probe_non_negative': ['value'],
    'dq_probe_between': ['value'],
    'uni_append_repeated': [],
    'sketch_median_rollup': [],
}
