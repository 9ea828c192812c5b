-- Late deliveries; the reports in this folder build on them.
CREATE OR REPLACE TEMP VIEW late_orders_vw AS
SELECT order_id, customer_state, delivery_days
FROM delivery_analysis_vw
WHERE is_late = TRUE;
