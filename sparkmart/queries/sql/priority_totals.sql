SELECT o_orderpriority, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM orders_source
WHERE o_totalprice >= :min_price
GROUP BY o_orderpriority;
