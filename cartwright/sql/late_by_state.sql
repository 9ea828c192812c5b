SELECT customer_state, count(*) AS late_orders, max(delivery_days) AS slowest_days
FROM late_orders_vw
GROUP BY customer_state;
