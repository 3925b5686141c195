-- The month of transactions that ends at :snap, with the window's bounds.
select t.*, add_months(:snap, -1) as first_day, :snap as last_day
from identifier(:tbl) t
where t.tx_date between add_months(:snap, -1) and :snap
