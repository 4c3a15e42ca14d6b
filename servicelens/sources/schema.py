"""Canonical column layout of the two input views.

``lines``  one row per service line (the fact table)
``assets`` one row per asset (vehicle) with its owner attributes

Operators address columns by these names only; identifier columns may be
strings (CSV source) or integers (star-schema adapter).
"""

from pyspark.sql import types as T

LINES_SCHEMA = T.StructType([
    T.StructField("line_id", T.StringType()),
    T.StructField("visit_id", T.StringType()),
    T.StructField("asset_id", T.StringType()),
    T.StructField("visit_date", T.DateType()),
    T.StructField("meter_km", T.DoubleType()),
    T.StructField("branch", T.StringType()),
    T.StructField("technician", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("qty", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("is_anchor", T.BooleanType()),
])

ASSETS_SCHEMA = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("owner_name", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("plate", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("trim", T.StringType()),
    T.StructField("model_year", T.DoubleType()),
    T.StructField("fuel", T.StringType()),
    T.StructField("drive", T.StringType()),
    T.StructField("oil_type", T.StringType()),
    T.StructField("interval_km", T.DoubleType()),
    T.StructField("segment", T.StringType()),
    T.StructField("km_per_month", T.DoubleType()),
])

LINE_COLUMNS = [f.name for f in LINES_SCHEMA.fields]
ASSET_COLUMNS = [f.name for f in ASSETS_SCHEMA.fields]

# Column names of the reference's input CSV files, mapped to
# the canonical names above.
SERVICE_CSV_COLUMNS = {
    "service_id": "line_id",
    "visit_id": "visit_id",
    "car_id": "asset_id",
    "tanggal": "visit_date",
    "km_saat_servis": "meter_km",
    "cabang": "branch",
    "mekanik": "technician",
    "kategori_servis": "category",
    "item_servis": "item",
    "qty": "qty",
    "harga": "price",
}
MASTER_CSV_COLUMNS = {
    "customer_id": "customer_id",
    "nama_pemilik": "owner_name",
    "no_telepon": "phone",
    "alamat": "address",
    "kecamatan": "district",
    "kota": "city",
    "kode_pos": "postcode",
    "car_id": "asset_id",
    "nopol": "plate",
    "model": "model",
    "varian": "trim",
    "tahun": "model_year",
    "bahan_bakar": "fuel",
    "penggerak": "drive",
    "transmisi": "transmission",
    "jenis_oli": "oil_type",
    "interval_oli_km": "interval_km",
    "segmen_pemakaian_asli": "segment",
    "km_per_bulan": "km_per_month",
}
CUSTOMER_CSV_COLUMNS = {
    "customer_id": "customer_id",
    "nama_pemilik": "owner_name",
    "no_telepon": "phone",
    "alamat": "address",
    "kecamatan": "district",
    "kota": "city",
    "kode_pos": "postcode",
}
