"""SQL text of the table bindings, for the DuckDB oracle.

Written independently of ``bazaar.sources.bindings`` (which uses the DataFrame API): the two must
describe the same logical tables. ``with_bindings(sql)`` prepends, as CTEs, exactly the bindings
that the query body mentions (and the ones those depend on).
"""

from __future__ import annotations

import re

BINDINGS: dict[str, str] = {
    "b_province": "select r_regionkey as ProvinceID, r_name as ProvinceName from region",
    "b_city": "select n_nationkey as CityID, n_regionkey as ProvinceID, n_name as CityName from nation",
    "b_customer": """select c_custkey as CustomerID, c_name as FirstName, c_mktsegment as LastName,
        'c' || cast(c_custkey as varchar) || '@shop.test' as Email, cast(null as varchar) as PhoneNumber,
        cast(c_custkey % 500 as int) as LoyaltyPoints, c_nationkey as CityID, c_custkey % 20 <> 0 as IsActive,
        cast(date '1995-01-01' + to_months(cast(c_custkey % 24 as int)) as timestamp) as CreatedAt
        from customer""",
    "b_address": """select c_custkey as AddressID, c_custkey as CustomerID, c_nationkey as CityID,
          cast(c_custkey as varchar) || ' Main Road' as AddressLine1, 'SHIPPING' as AddressType, true as IsDefault
        from customer
        union all
        select c_custkey + 1000000000, c_custkey, (c_nationkey + 1) % 25,
          cast(c_custkey as varchar) || ' Office Park', 'BILLING', false
        from customer where c_custkey % 3 = 0""",
    "b_vendor": """select s_suppkey as VendorID, s_name as VendorName,
        'v' || cast(s_suppkey as varchar) || '@vendor.test' as Email,
        cast(5 + s_suppkey % 11 as decimal(5,2)) as CommissionRate, s_suppkey % 3 = 0 as IsVerified,
        s_suppkey % 10 <> 0 as IsActive, timestamp '1994-06-01 00:00:00' as CreatedAt from supplier""",
    "b_category": """select *, CategoryID % 7 <> 3 as IsActive, 'cat-' || cast(CategoryID as varchar) as CategorySlug
        from (select cast(r_regionkey + 1 as int) as CategoryID, cast(null as int) as ParentCategoryID,
                     r_name as CategoryName from region
              union all select cast(n_nationkey + 100 as int), cast(n_regionkey + 1 as int), n_name from nation
              union all select cast(s_suppkey + 10000 as int), cast(s_nationkey + 100 as int), s_name from supplier)""",
    "b_product": """select p_partkey as ProductID, p_partkey % (select count(*) from supplier) as VendorID,
        cast(10000 + (p_partkey * 3) % (select count(*) from supplier) as int) as CategoryID,
        p_name as ProductName, 'p-' || cast(p_partkey as varchar) as ProductSlug, p_type as ProductType,
        cast(p_retailprice as decimal(18,2)) as BasePrice, p_partkey % 20 <> 0 as IsActive from part""",
    "b_variant": """select p_partkey as VariantID, p_partkey as ProductID, 'SKU-' || cast(p_partkey as varchar) as SKU,
        cast(p_size as varchar) as SizeName, p_brand as ColourName, cast(0 as decimal(10,2)) as PriceAdjustment,
        p_partkey % 50 <> 7 as IsActive from part""",
    "b_order": """select o_orderkey as OrderID, o_custkey as CustomerID, o_custkey as ShippingAddressID,
        case when o_orderkey % 3 = 0 then cast(o_orderkey % 25 as int) end as DiscountID,
        case o_orderstatus when 'F' then 'DELIVERED' when 'O' then 'CONFIRMED' else 'CANCELLED' end as OrderStatus,
        cast(o_totalprice as decimal(18,2))
          + cast(cast(o_totalprice as decimal(18,2)) * cast((o_orderkey % 10) as decimal(2,0)) * 0.01 as decimal(18,4))
          as SubtotalAmount,
        cast(cast(o_totalprice as decimal(18,2)) * cast((o_orderkey % 10) as decimal(2,0)) * 0.01 as decimal(18,4))
          as DiscountAmount,
        cast(0 as decimal(18,2)) as ShippingAmount,
        cast(o_totalprice as decimal(18,2)) as TotalAmount, o_orderdate as PlacedAt, o_orderdate as UpdatedAt
        from orders""",
    "b_line": """select l_orderkey * 8 + l_linenumber as OrderLineID, l_orderkey as OrderID, l_linenumber as LineNumber, l_partkey as VariantID,
        l_partkey as ProductID, l_suppkey as SupplierID, cast(l_quantity as int) as Quantity,
        cast(cast((cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) + cast(l_quantity as int) // 2)
                  // cast(l_quantity as int) as decimal(18,2)) * 0.01 as decimal(18,2)) as UnitPrice,
        cast(l_extendedprice as decimal(18,2)) as LineTotal from lineitem""",
    "b_payment": """select o_orderkey as PaymentID, o_orderkey as OrderID,
          ['CREDIT_CARD','EFT','INSTANT_EFT','SNAPSCAN','MOBICRED','PAYFLEX'][o_orderkey % 6 + 1] as PaymentMethod,
          case o_orderstatus when 'F' then 'CAPTURED' when 'O' then 'AUTHORISED' else 'FAILED' end as PaymentStatus,
          cast(o_totalprice as decimal(18,2)) as Amount,
          case when o_orderstatus = 'F' then o_orderdate end as PaidAt, o_orderdate as CreatedAt
        from orders
        union all
        select o_orderkey + 1000000000, o_orderkey,
          ['CREDIT_CARD','EFT','INSTANT_EFT','SNAPSCAN','MOBICRED','PAYFLEX'][(o_orderkey + 1) % 6 + 1], 'FAILED',
          cast(o_totalprice as decimal(18,2)), cast(null as timestamp), o_orderdate
        from orders where o_orderkey % 7 = 0""",
    "b_courier": "select r_regionkey as CourierID, r_name || ' Couriers' as CourierName, true as IsActive from region",
    "b_shipment": """select o_orderkey as ShipmentID, o_orderkey as OrderID, cast(o_orderkey % 5 as int) as CourierID,
        'TRK' || cast(o_orderkey as varchar) as TrackingNumber,
        case when o_orderstatus = 'F' then 'DELIVERED' else 'IN_TRANSIT' end as ShipmentStatus,
        cast(o_orderdate as date) + 5 as EstimatedDelivery,
        case when o_orderstatus = 'F' then o_orderdate + to_days(cast(o_orderkey % 9 as int)) end as ActualDelivery,
        o_orderdate as CreatedAt
        from orders where o_orderstatus in ('F', 'O')""",
    "b_shipevent": """select event_id as EventID, user_id as ShipmentID, event_type as EventStatus,
        props as EventLocation, ts as EventAt from events""",
    "b_discount": """select n_nationkey as DiscountID, 'SAVE' || cast(n_nationkey as varchar) as DiscountCode,
        ['PERCENTAGE','FIXED_AMOUNT','FREE_SHIPPING'][n_nationkey % 3 + 1] as DiscountType,
        cast(5 + n_nationkey as decimal(10,2)) as DiscountValue, cast(null as decimal(10,2)) as MinOrderValue,
        100 + n_nationkey * 10 as MaxUsageCount, n_nationkey * 7 as UsageCount,
        cast(date '2000-01-01' + to_months(n_nationkey) as timestamp) as ValidFrom,
        case when n_nationkey % 4 <> 0
             then cast(date '2000-01-01' + to_months(n_nationkey + 12) as timestamp) end as ValidTo,
        n_nationkey % 5 <> 0 as IsActive from nation""",
    "b_warehouse": """select r_regionkey as WarehouseID, r_name || ' DC' as WarehouseName, r_regionkey as CityID,
        true as IsActive from region where r_regionkey < 3""",
    "b_stock": """select p_partkey * 3 + w.WarehouseID as StockLevelID, w.WarehouseID, p_partkey as VariantID,
        cast((p_partkey * 7 + w.WarehouseID * 13) % 40 as int) as QuantityOnHand,
        cast(10 + p_partkey % 5 as int) as ReorderPoint
        from part cross join (select 0 as WarehouseID union all select 1 union all select 2) w""",
    "b_review": """select event_id as ReviewID, event_id % (select count(*) from part) as ProductID, user_id as CustomerID,
        cast(1 + event_id % 5 as int) as Rating, event_id % 4 <> 0 as IsApproved, ts as CreatedAt
        from events where event_type = 'click'""",
    "b_review_doc": """select event_id % (select count(*) from part) as product_id, user_id as customer_id, cast(1 + event_id % 5 as int) as rating,
        'review ' || cast(event_id as varchar) as title, event_id % 4 <> 0 as is_approved,
        cast(json_extract_string(props, '$.k') as int) * 2 as helpful_votes,
        ['t' || cast(event_id % 7 as varchar), 'u' || cast(user_id % 5 as varchar)] as tags,
        ts as created_at from events where event_type = 'click'""",
    "b_pevent": """select user_id as customer_id, event_id % (select count(*) from part) as product_id,
        case event_type when 'view' then 'VIEW' when 'click' then 'ADD_TO_CART' when 'purchase' then 'PURCHASE'
             else upper(event_type) end as event_type, ts as created_at from events""",
    "b_text_review": """select doc_id as review_id, doc_id as product_id, doc_id % 97 as customer_id,
        cast(1 + doc_id % 5 as int) as rating, source as title, text as body, lang,
        doc_id % 4 <> 0 as is_approved from documents""",
    "b_point": """select s_suppkey as vendor_id, s_name as vendor_name, 28.0473 + ((s_suppkey * 37) % 100 - 50) * 0.005 as lon,
        -26.2041 + ((s_suppkey * 53) % 100 - 50) * 0.005 as lat, s_suppkey % 2 = 0 as pickup_available from supplier""",
}

_NAME = re.compile(r"\bb_[a-z_]+\b")


def with_bindings(body: str) -> str:
    """Prefix ``body`` with the CTEs for every ``b_*`` binding it references.

    ``body`` may itself start with ``WITH`` (its CTEs are appended after the bindings)."""
    used = [n for n in BINDINGS if re.search(rf"\b{n}\b", body)]
    ctes = ",\n".join(f"{n} AS ({BINDINGS[n]})" for n in used)
    stripped = body.lstrip()
    if stripped[:4].lower() == "with":
        rest = stripped[4:].lstrip()
        if rest[:9].lower() == "recursive":
            return f"WITH RECURSIVE {ctes},\n{rest[9:].lstrip()}" if ctes else body
        return f"WITH {ctes},\n{rest}" if ctes else body
    return f"WITH {ctes}\n{body}" if ctes else body
