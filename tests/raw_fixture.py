"""Hand-made raw documents with the dirt the staging models must survive."""

from __future__ import annotations

import json


def tables(spark):
    def address(city, cp, pais, lat, lon, street="Mitre", number="10", comment=None):
        return json.dumps(
            {
                "city": {"name": city}, "state": {"name": "Córdoba"}, "country": {"id": pais}, "zip_code": cp,
                "latitude": lat, "longitude": lon, "street_name": street, "street_number": number, "comment": comment,
            }
        )

    vtex = [
        # two versions of one order; the newer one counts
        ("v1", "invoiced", 10050, "2024-01-01T10:00:00.0000000+00:00", "2024-01-02T10:00:00.0000000+00:00",
         json.dumps({"userProfileId": "u1", "email": None, "firstName": "Ana", "lastName": "Paz", "phone": "1"}),
         json.dumps({"address": {"street": "San Martín", "number": "5", "city": "CÓRDOBA", "state": "Córdoba",
                                 "postalCode": "5000", "country": "ARG"}}),
         json.dumps([{"productId": "p1", "name": "Tele", "quantity": 2, "sellingPrice": 2500},
                     {"productId": "p1", "name": "Tele", "quantity": 1, "sellingPrice": 5050}])),
        ("v1", "created", 1, "2024-01-01T10:00:00.0000000+00:00", "2024-01-01T10:00:00.0000000+00:00",
         json.dumps({"userProfileId": "u1", "email": "ana@x.com", "firstName": "Ana"}), "direccion_000016", "[]"),
        # anonymised address, no items, unreadable date
        ("v2", "canceled", 500, "soon", "2024-01-05T10:00:00.0000000+00:00",
         json.dumps({"userProfileId": "u2", "email": "b@x.com"}), "direccion_000017", None),
        # no customer id
        ("v3", "invoiced", 700, "2024-02-01T00:00:00.0000000+00:00", "2024-02-01T00:00:00.0000000+00:00",
         json.dumps({"email": "anon@x.com"}), None, '[{"productId": null, "name": "Cable", "quantity": "1.0", "sellingPrice": 700}]'),
    ]
    meli = [
        (1, "paid", 99.5, "2024-01-03T10:00:00.000-04:00", "2024-01-03T11:00:00.000-04:00", None,
         json.dumps({"id": 77, "email": "m@x.com", "nickname": "MELI77"}),
         json.dumps([{"item": {"id": "MLA1", "title": "Radio", "category_id": "C1"}, "quantity": 1.0,
                      "unit_price": 99.5, "currency_id": "ARS"}])),
        (1, "pending", 1.0, "2024-01-03T10:00:00.000-04:00", "2024-01-03T10:00:00.000-04:00", None,
         json.dumps({"id": 77, "email": "m@x.com", "nickname": "MELI77"}), "[]"),
        (2, "paid", 10.0, "2024-03-03T10:00:00.000-04:00", None, "2024-03-05T10:00:00.000-04:00", None,
         json.dumps([{"item": {"id": "MLA1", "title": "Radio"}, "quantity": 3, "unit_price": 90}])),
    ]
    garbarino = [
        (9, "ok", "2020-01-05 08:00:00", json.dumps({"id": "g1", "email": "g@x.com", "name": "Gala"}),
         json.dumps({"total": "1234.5"}),
         json.dumps({"street": "Alem", "number": "1", "city": "Rosario", "state": "Santa Fe", "zip": "2000", "country": None}),
         json.dumps([{"product_id": 4, "title": "Silla", "quantity": 2, "price": 617.25}])),
    ]
    shipments = [
        (50, "1", "shipped", None, "me2", "T1", "c", "2024-01-03T12:00:00.000-04:00", "2024-01-04T12:00:00.000-04:00",
         address("Rosario", "2000", "AR", -32.9, -60.6), address("CÓRDOBA", "5000", None, 0, 0)),
        (50, "1", "old", None, "me2", "T1", "c", "2024-01-03T12:00:00.000-04:00", "2024-01-03T12:00:00.000-04:00",
         None, address("Salta", "4400", "AR", -24.8, -65.4)),
    ]
    payments = [
        (70, 1, "approved", "ok", "2024-01-03T10:00:00.000-04:00", None, "99.5", 99.5, 90.0, "x", None, "card", "visa",
         "3.0", "ARS", json.dumps({"id": 77, "email": "m@x.com", "first_name": "Mel", "last_name": None})),
        (70, 1, "pending", "w", "2024-01-02T10:00:00.000-04:00", None, "99.5", 99.5, 90.0, "x", None, "card", "visa",
         "3.0", "ARS", "token"),
    ]
    pickups = [
        ("pk1", 2, "ready", "2024-03-04T10:00:00.000-04:00", None, 77,
         json.dumps({"id": 5, "name": "Centro", "location": {"latitude": -31.4, "longitude": -64.2, "address":
                     {"city": "Córdoba", "state": "Córdoba", "zip_code": "5001", "address_line": "Colón 1"}}}),
         json.dumps({"name": "Mel", "id_type": "DNI", "id_number": 123})),
    ]
    coords = [
        ("k1", "-31.5", "-64.1", "Córdoba", "Córdoba", "1500000.0", "exact"),
        ("k1", None, None, "Córdoba", "Córdoba", None, "none"),
        (None, "1", "1", None, None, None, None),
    ]
    make = spark.createDataFrame
    return {
        "vtex_pedido": make(
            vtex, "orderId string, status string, value bigint, creationDate string, lastChange string,"
            " clientProfileData string, shippingData string, items string"),
        "meli_pedido": make(
            meli, "id bigint, status string, total_amount double, date_created string, last_updated string,"
            " date_closed string, buyer string, order_items string"),
        "garbarino_pedido": make(
            garbarino, "id int, status string, created string, customer string, totals_sale string,"
            " billing_address string, sold_items string"),
        "type_6": make(
            shipments, "id int, order_id string, status string, substatus string, logistic_type string,"
            " tracking_number string, tracking_method string, date_created string, last_updated string,"
            " sender_address string, receiver_address string"),
        "type_8": make(
            payments, "id int, order_id bigint, status string, status_detail string, date_created string,"
            " date_approved string, transaction_amount string, total_paid_amount double, net_received_amount double,"
            " mercadopago_fee string, marketplace_fee double, payment_type string, payment_method_id string,"
            " installments string, currency_id string, payer string"),
        "meli_pickup": make(
            pickups, "id string, order_id int, status string, date_created string, date_ready string,"
            " buyer_id bigint, store_info string, pickup_person string"),
        "geo_coords": make(
            coords, "direccion_id string, latitud string, longitud string, matched_city string,"
            " matched_provincia string, population string, match_type string"),
    }
