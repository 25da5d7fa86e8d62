"""The golden fixture: 9 raw rows (one repeated, one without a date) and the
7 cube rows they give, in the stored column order (empty = null)."""

import datetime as dt

RAW_CSV = """sale_id,customer_id,product_id,quantity,sale_date,price_product,sale_amount,region
1,10,1,2,2025-12-05,10.33,20.66,North
2,11,1,1,2025-12-20,10.33,10.33,North
2,11,1,1,2025-12-20,10.33,10.33,North
3,12,1,3,2026-01-02,10.33,30.99,North
4,13,52,5,2025-12-31,1000.19,5000.95,West
5,10,52,7,2026-01-31,1000.19,7001.33,West
6,14,30,4,2026-01-15,250.4,1001.6,East
7,15,30,1,2026-01-16,250.4,250.4,South
8,15,30,2,,250.4,500.8,South
"""

EXPECTED_CUBE = """
East|30|January|1|2026|1001.6|1001|1|4|4.0|1001.6|1001|1|4|4.0|2071.1|8283|4|15|3.8|584.3|1751|2|7|2.3
North|1|December|12|2025|15.5|31|2|3|1.5|23.3|62|3|6|2.3|2508.3|5032|3|8|3.3|23.3|62|3|6|2.3
North|1|January|1|2026|31.0|31|1|3|3.0|23.3|62|3|6|2.3|2071.1|8283|4|15|3.8|23.3|62|3|6|2.3
South|30||||500.8|500|0|2|2.0|375.6|750|1|3|1.5|500.8|500|0|2|2.0|584.3|1751|2|7|2.3
South|30|January|1|2026|250.4|250|1|1|1.0|375.6|750|1|3|1.5|2071.1|8283|4|15|3.8|584.3|1751|2|7|2.3
West|52|December|12|2025|5001.0|5001|1|5|5.0|6001.2|12002|2|12|6.0|2508.3|5032|3|8|3.3|6001.2|12002|2|12|6.0
West|52|January|1|2026|7001.3|7001|1|7|7.0|6001.2|12002|2|12|6.0|2071.1|8283|4|15|3.8|6001.2|12002|2|12|6.0
"""


def expected_rows():
    """Expected cube rows as tuples of Python values."""
    rows = []
    for line in EXPECTED_CUBE.strip().splitlines():
        f = line.split("|")
        out = []
        for i, v in enumerate(f):
            if v == "":
                out.append(None)
            elif i in (0, 2):
                out.append(v)
            elif "." in v:
                out.append(float(v))
            else:
                out.append(int(v))
        rows.append(tuple(out))
    return rows


def raw_rows():
    lines = RAW_CSV.strip().splitlines()[1:]
    out = []
    for line in lines:
        f = line.split(",")
        out.append((int(f[0]), int(f[1]), int(f[2]), int(f[3]),
                    dt.date.fromisoformat(f[4]) if f[4] else None,
                    float(f[5]), float(f[6]), f[7]))
    return out
