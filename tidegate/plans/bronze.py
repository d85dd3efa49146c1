"""Quality rules of the raw feeds."""

from __future__ import annotations

# A raw row is kept only if all predicates of its feed hold.
CUSTOMER_RULES = {
    "email": "email is not null",
    "date_of_birth": "date_of_birth is not null",
    "street_name": "street_name is not null",
}
ORDER_RULES = {
    "quantity": "quantity > 0",
    "amount": "amount > 0",
    "order_date": "order_date is not null",
}
PRODUCT_RULES = {
    "category": "category is not null",
    "product_name": "product_name is not null",
    "price": "price > 0",
    "expiry_date": "expiry_date is not null",
}

# Column types that the feeds declare; the others follow their values.
CUSTOMER_TYPES = {"phone_number": "string", "date_of_birth": "string", "email": "string"}
ORDER_TYPES = {"quantity": "int", "amount": "double", "order_date": "string"}
PRODUCT_TYPES = {"price": "double", "expiry_date": "string"}
