SELECT order_status, count(*) AS orders, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM analytics_orders
GROUP BY order_status
ORDER BY orders DESC, order_status;
