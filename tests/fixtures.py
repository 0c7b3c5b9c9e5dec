"""Hand-made inputs of the tests: the mini-month of the golden tests.

Five order documents of the month and their customers and refunds, all of our own making. P-301
comes twice; the first line of P-302 is rejected (D9); P-303 has an inactive
customer; P-304 is not paid.
"""

from __future__ import annotations

import json
import os

CUSTOMERS_CSV = "customer_id,city,is_active\nk11,Nantes,1\nk12,Dijon,TRUE\nk13,Nantes,no\n"
REFUNDS_CSV = "order_id,amount,created_at\nP-301,4.25,2025-03-09\nP-301,0.5,2025-03-10\nP-999,31,2025-03-11\n"

DAY1 = [
    {"order_id": "P-301", "customer_id": "k11", "channel": "store", "created_at": "2025-03-01 08:20:00",
     "payment_status": "paid", "items": [{"qty": 4, "unit_price": 6.5}, {"qty": 2, "unit_price": 1.75}]},
    {"order_id": "P-302", "customer_id": "k12", "channel": "phone", "created_at": "2025-03-01 21:05:30",
     "payment_status": "paid", "items": [{"qty": 3, "unit_price": -2.4}, {"qty": 5, "unit_price": 7.2}]},
    {"order_id": "P-303", "customer_id": "k13", "channel": "store", "created_at": "2025-03-01 06:45:00",
     "payment_status": "paid", "items": [{"qty": 8, "unit_price": 12.1}]},
]
# day 2 uses the other item field names (evolving schema)
DAY2 = [
    {"order_id": "P-301", "customer_id": "k11", "channel": "store", "created_at": "2025-03-01 17:40:00",
     "payment_status": "paid", "items": [{"quantity": 6, "price": 15.3}]},
    {"order_id": "P-304", "customer_id": "k11", "channel": "phone", "created_at": "2025-03-02 13:10:00",
     "payment_status": "pending", "items": [{"quantity": 2, "price": 3.6}]},
]
# another month, and a name that is not a day: both must be ignored
OTHER = [
    {"order_id": "P-401", "customer_id": "k11", "channel": "phone", "created_at": "2025-04-01 10:30:00",
     "payment_status": "paid", "items": [{"qty": 7, "unit_price": 20.0}]},
]


def write_mini_month(root: str) -> str:
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/customers.csv", "w") as f:
        f.write(CUSTOMERS_CSV)
    with open(f"{root}/refunds.csv", "w") as f:
        f.write(REFUNDS_CSV)
    with open(f"{root}/orders_2025-03-01.json", "w") as f:
        json.dump(DAY1, f, indent=2)
    with open(f"{root}/orders_2025-03-02.json", "w") as f:
        json.dump(DAY2, f, indent=2)
    with open(f"{root}/orders_2025-03-03.json", "w") as f:
        f.write('[{"order_id": "bad", "items": [ }')  # malformed
    open(f"{root}/orders_2025-03-04.json", "w").close()  # zero bytes
    with open(f"{root}/orders_2025-04-01.json", "w") as f:
        json.dump(OTHER, f)
    with open(f"{root}/orders_2025-03-32.json", "w") as f:
        json.dump(OTHER, f)
    return root
