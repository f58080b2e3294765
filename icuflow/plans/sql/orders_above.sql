SELECT o_orderpriority AS priority,
       count(*) AS n_orders,
       round(sum(o_totalprice), 2) AS total
FROM orders
WHERE o_totalprice > :floor
GROUP BY o_orderpriority
