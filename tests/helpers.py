"""Literal tables shared by the tests (fixtures stay in conftest.py)."""

SF0001 = "/root/testdata/sf0.001"

CAT_COLS = ["pos", "vendor", "product_category", "product_sub_category", "product_id",
            "product_name", "product_quantity", "product_price", "product_url", "image_url",
            "product_desc"]


def catalogue(spark, rows, vendor="Alpha"):
    """Literal catalogue rows: (pos, name[, desc[, id]])."""
    data = []
    for r in rows:
        pos, name = r[0], r[1]
        desc = r[2] if len(r) > 2 else ""
        pid = r[3] if len(r) > 3 else f"P{pos}"
        data.append((pos, vendor, "cat", "sub", pid, name, "1", "1.00", f"u{pos}", f"i{pos}", desc))
    schema = ("pos long, vendor string, product_category string, product_sub_category string, "
              "product_id string, product_name string, product_quantity string, "
              "product_price string, product_url string, image_url string, product_desc string")
    return spark.createDataFrame(data, schema)
