"""Shared tables for the comparison SQL, written from the definitions and not from the Spark plans."""

BASE = """
raw_facts as (
  select l_orderkey*10 + l_linenumber as fact_id,
         l_partkey as product_id,
         year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate) as time_id,
         cast(l_shipdate as date) as ship_day,
         round(l_extendedprice*(1-l_discount), 4) as price,
         l_extendedprice as original_price,
         round(l_discount*500, 4) as discount_percentage,
         case when l_orderkey % 97 = 5 then 'Maybe'
              when l_returnflag = 'R' then 'Out of Stock'
              when l_returnflag = 'N' then 'Low Stock' else 'In Stock' end as availability,
         cast(l_quantity as int) as stock_level,
         case when l_linenumber = 7 then null else 1 + cast(l_suppkey % 41 as double)/10 end as rating,
         l_orderkey % 500 as review_count,
         round(l_quantity*(1+l_tax), 4) as sales_velocity,
         l_returnflag = 'R' as is_trending,
         row_number() over (partition by l_orderkey*10 + l_linenumber
                            order by cast(l_shipdate as date) desc, l_partkey desc,
                                     l_extendedprice desc, l_suppkey desc, l_quantity desc,
                                     l_discount desc, l_tax desc, l_returnflag desc) as rn
  from lineitem
),
last_facts as (select * exclude (rn) from raw_facts where rn = 1),
fact_reasons as (
  select *, case
    when fact_id is null then 'not_null:fact_id' when fact_id <= 0 then 'gt_0:fact_id'
    when product_id is null then 'not_null:product_id' when product_id <= 0 then 'gt_0:product_id'
    when time_id is null then 'not_null:time_id' when time_id <= 0 then 'gt_0:time_id'
    when price is null then 'not_null:price' when price <= 0 then 'gt_0:price'
    when original_price <= 0 then 'gt_0:original_price'
    when discount_percentage is null then 'not_null:discount_percentage'
    when not (discount_percentage between 0 and 95) then 'between_0_95:discount_percentage'
    when availability is null then 'not_null:availability'
    when availability not in ('In Stock', 'Low Stock', 'Out of Stock', 'Pre-Order')
      then 'isin:availability'
    when stock_level is null then 'not_null:stock_level' when stock_level < 0 then 'ge_0:stock_level'
    when not (rating between 0 and 5) then 'between_0_5:rating'
    when review_count is null then 'not_null:review_count'
    when review_count < 0 then 'ge_0:review_count'
    when sales_velocity is null then 'not_null:sales_velocity'
    when sales_velocity < 0 then 'ge_0:sales_velocity'
    when is_trending is null then 'not_null:is_trending' end as reason
  from last_facts
),
bronze_facts as (select * exclude (reason) from fact_reasons where reason is null),
days as (select distinct year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate) as time_id,
                cast(l_shipdate as date) as full_date from lineitem),
raw_products as (
  select p_partkey as product_id, p_name as name, p_type as category,
         chr(91) || chr(39) || p_brand || chr(39) || ', ' || chr(39) || p_type || chr(39) || chr(93)
           as subcategory,
         p_brand as brand, p_retailprice as base_price, cast(p_size as double)/10 as base_rating,
         'https://img.example/' || cast(p_partkey as varchar) as image_url
  from part
),
bronze_products as (
  select * from raw_products
  where product_id > 0 and length(name) >= 1 and category is not null and base_price > 0
    and base_rating between 0 and 5
),
products as (
  select product_id, trim(name) as product_name,
    case when contains(lower(name), 'bolt') or contains(lower(name), 'ring') then 'Hardware'
         when contains(lower(name), 'rod') or contains(lower(name), 'plate') then 'Hardware'
         when contains(lower(name), 'gizmo') or contains(lower(name), 'widget') then 'Gadgets'
         else 'General Merchandise' end as category,
    case when contains(lower(name), 'bolt') or contains(lower(name), 'ring') then 'Fasteners'
         when contains(lower(name), 'rod') or contains(lower(name), 'plate') then 'Bar stock'
         when contains(lower(name), 'gizmo') or contains(lower(name), 'widget') then 'Gadgets'
         else 'General' end as subcategory,
    case when contains(lower(name), 'red') then 'Red' when contains(lower(name), 'blue') then 'Blue'
         when contains(lower(name), 'hot') then 'Hot' when contains(lower(name), 'cold') then 'Cold'
         when contains(lower(name), 'old') then 'Old' else 'House Brand' end as brand,
    'Unisex' as audience,
    split_part(subcategory, chr(39), 2) || '|' || split_part(subcategory, chr(39), 4) as color_options,
    base_price, base_rating, image_url, category as source_category, brand as source_brand
  from bronze_products
),
observations as (
  select * exclude (ord) from (
    select product_id, full_date as observed_date, price, original_price, discount_percentage,
           availability, stock_level, rating, review_count, sales_velocity, is_trending,
           row_number() over (partition by product_id, full_date order by fact_id desc) as ord
    from bronze_facts join days using (time_id))
  where ord = 1
),
features as (
  select *,
    lag(price, 1) over w as price_lag_1,
    lag(price, 7) over w as price_lag_7,
    case when count(*) over w7 >= 7 then avg(price) over w7 end as price_ma_7,
    case when count(*) over w30 >= 30 then avg(price) over w30 end as price_ma_30,
    case when count(*) over w7 >= 7 then stddev_samp(price) over w7 end as price_std_7,
    (price / nullif(lag(price, 1) over w, 0) - 1) * 100 as price_pct_change,
    lag(sales_velocity, 1) over w as velocity_lag_1,
    case when count(*) over w7 >= 7 then avg(sales_velocity) over w7 end as velocity_ma_7,
    extract(isodow from observed_date) as day_of_week,
    extract(isodow from observed_date) >= 6 as is_weekend,
    extract(month from observed_date) as month_num
  from observations
  window w as (partition by product_id order by observed_date),
         w7 as (partition by product_id order by observed_date rows between 6 preceding and current row),
         w30 as (partition by product_id order by observed_date
                 rows between 29 preceding and current row)
),
profile as (
  select product_id, avg(price) as avg_price,
         coalesce(stddev_samp(price) / nullif(avg(price), 0), 0) as price_volatility,
         avg(discount_percentage) as avg_discount, coalesce(avg(rating), 0) as avg_rating,
         avg(sales_velocity) as avg_velocity
  from observations group by product_id
),
history as (
  select product_id, product_name, category, subcategory, brand, audience, color_options, base_price,
         base_rating, image_url, timestamp '1995-01-01' as valid_from,
         case when product_id % 10 = 0 then timestamp '1998-07-01' end as valid_to
  from products
  union all
  select product_id, product_name, category, subcategory, 'Brand#99', audience, color_options,
         base_price, base_rating, image_url, timestamp '1998-07-01', null
  from products where product_id % 10 = 0
),
dim_product as (
  select md5(concat_ws('|', product_id, valid_from)) as product_sk, product_id as product_nk,
         * exclude (product_id, valid_from, valid_to),
         if(valid_from = min(valid_from) over (partition by product_id),
            make_timestamp(1900, 1, 1, 0, 0, 0), valid_from) as valid_from,
         ifnull(valid_to, make_timestamp(9999, 12, 31, 0, 0, 0)) as valid_to,
         valid_to is null as is_current
  from history
),
dim_date as (
  select year(d)*10000 + month(d)*100 + day(d) as date_sk, d as full_date, year(d) as year,
         (month(d) + 2) // 3 as quarter, month(d) as month, monthname(d) as month_name,
         (dayofyear(d) + 7 - isodow(d)) // 7 as week_of_year, isodow(d) as day_of_week,
         dayname(d) as day_name, isodow(d) in (6, 7) as is_weekend
  from (select cast(b.first_day + n.i * interval 1 day as date) as d
        from (select min(observed_date) as first_day, max(observed_date) as last_day
              from observations) b, range(0, 20000) n(i)
        where n.i <= b.last_day - b.first_day + 60)
),
facts as (
  select dim_product.product_sk, observations.product_id as product_nk,
         year(observed_date)*10000 + month(observed_date)*100 + day(observed_date) as date_sk,
         observations.* exclude (product_id, observed_date)
  from observations asof join dim_product
    on observations.product_id = dim_product.product_nk
   and observations.observed_date >= dim_product.valid_from
),
version_stats as (
  select product_sk, avg(price) as p_avg, min(price) as p_min, max(price) as p_max,
         stddev_samp(price) as p_dev, avg(rating) as r_avg, max(review_count) as n_reviews,
         avg(discount_percentage) as d_avg, avg(sales_velocity) as v_avg, count(*) as n
  from facts group by product_sk
),
performance as (
  select product_nk as product_id, product_name, category, subcategory, brand, audience, image_url,
         base_rating, p_avg as avg_price, p_min as min_price, p_max as max_price, r_avg as avg_rating,
         n_reviews as total_reviews, d_avg as avg_discount,
         case when p_avg <> 0 then p_dev / p_avg end as price_volatility, n as data_points,
         v_avg as avg_sales_velocity
  from dim_product join version_stats using (product_sk) where is_current
),
latest as (
  select * from facts qualify date_sk = max(date_sk) over (partition by product_nk)
),
deals as (
  select product_nk as product_id, product_name, category, brand, image_url, price as current_price,
         original_price, discount_percentage, rating,
         strptime(cast(date_sk as varchar), '%Y%m%d')::date as observed_date
  from latest join (select product_sk, product_name, category, brand, image_url from dim_product)
    using (product_sk)
  where not discount_percentage < 15
),
rollup_daily as (
  select category, strptime(cast(date_sk as varchar), '%Y%m%d')::date as full_date,
         count(distinct product_nk) as products_observed, avg(price) as avg_price,
         min(price) as min_price, max(price) as max_price, avg(discount_percentage) as avg_discount,
         sum(sales_velocity) as total_sales_velocity
  from facts join (select product_sk, category from dim_product) using (product_sk)
  group by category, date_sk
),
segments as (
  select product_id, case when base_price >= 950 then 'Premium' else 'Value' end as segment_name
  from products
),
scored as (
  select *, 0.6745 * centered / (median(abs(centered)) over (partition by product_id) + 1e-9) as robust_z
  from (select *, price_pct_change - median(price_pct_change) over (partition by product_id) as centered
        from features where price_pct_change is not null and price_std_7 is not null)
),
flagged as (
  select *, abs(robust_z) > 3.5 and abs(price_pct_change) >= 10
            and rank() over (order by abs(robust_z) desc)
                + (count(*) over (partition by abs(robust_z)) - 1) / 2.0
                <= greatest(1, cast(floor(count(*) over () * 0.01) as bigint)) as zscore_flag
  from scored
),
dirty_products as (
  select product_id, case when product_id % 13 = 1 then '' else name end as name,
         case when product_id % 23 = 1 then null else category end as category, subcategory, brand,
         case when product_id % 17 = 1 then -base_price else base_price end as base_price,
         case when product_id % 19 = 1 then 9.0 else base_rating end as base_rating, image_url
  from raw_products
),
dirty_observations as (
  select fact_id, product_id, full_date as observed_date,
         case when review_count % 50 = 0 then null else price end as price,
         case when stock_level = 1 then null when stock_level = 2 then original_price / 2
              else original_price end as original_price,
         case when stock_level = 3 then discount_percentage + 60 else discount_percentage end
           as discount_percentage, rating
  from raw_facts join days using (time_id)
)
""".strip()
