"""Reading the service-history CSV layout."""

from pyspark.sql import functions as F

from servicelens.operators import kpi, visits
from servicelens.params import Params
from servicelens.sources.csv_source import denormalize_master, load_assets, load_customers, load_service_lines

SERVICE_CSV = """service_id,visit_id,car_id,tanggal,km_saat_servis,cabang,mekanik,kategori_servis,item_servis,qty,harga
SVC000001,V000001,CAR0001,2024-01-05,12000,Cabang A,Mekanik X,Oli & Filter,Ganti Oli Mesin,1,450000
SVC000002,V000001,CAR0001,2024-01-05,12000,Cabang A,Mekanik X,Oli & Filter,Filter Oli,,90000
SVC000003,V000002,CAR0002,bad-date,x,Cabang B,Mekanik Y,Lainnya,Wiper,2,oops
"""
MASTER_CSV = """customer_id,nama_pemilik,no_telepon,alamat,kecamatan,kota,kode_pos,car_id,nopol,model,varian,tahun,bahan_bakar,penggerak,transmisi,jenis_oli,interval_oli_km,segmen_pemakaian_asli,km_per_bulan
CUST0001,Budi Siregar,081234567890,Jl. A,Medan Kota,Medan,020212,CAR0001,BK 1 AB,Avanza,1.5 G,2020,Bensin,FWD,AT,Semi-Sintetik,7000,Heavy Daily,2500.5
CUST0002,Siti Lubis,082200000001,Jl. B,Medan Baru,Medan,020153,CAR0002,BK 2 CD,Agya,1.2 G,n/a,Bensin,FWD,MT,Mineral,4500,Light Commuter,800
"""
CUSTOMER_CSV = """customer_id,nama_pemilik,no_telepon,alamat,kecamatan,kota,kode_pos
CUST0001,Budi Siregar,081234567890,Jl. A,Medan Kota,Medan,020212
"""


def test_csv_layout_roundtrip(spark, tmp_path):
    (tmp_path / "svc.csv").write_text(SERVICE_CSV)
    (tmp_path / "master.csv").write_text(MASTER_CSV)
    (tmp_path / "cust.csv").write_text(CUSTOMER_CSV)
    p = Params()
    lines = load_service_lines(spark, str(tmp_path / "svc.csv"), p)
    assets = load_assets(spark, str(tmp_path / "master.csv"))
    rows = {r.line_id: r for r in lines.collect()}
    assert rows["SVC000001"].is_anchor and rows["SVC000002"].qty == 1
    assert rows["SVC000003"].visit_date is None and rows["SVC000003"].price is None
    a = {r.asset_id: r for r in assets.collect()}
    assert a["CAR0001"].phone == "081234567890" and a["CAR0002"].model_year is None
    assert load_customers(spark, None) is None
    cust = load_customers(spark, str(tmp_path / "cust.csv"))
    assert cust.first().postcode == "020212"
    k = kpi.kpi_summary(lines, assets).first()
    assert k.visits == 2 and k.anchor_visits == 1 and k.total_revenue == 540000.0
    v = visits.build_visits(lines, assets).where(F.col("visit_id") == "V000001").first()
    assert v.items == ["Filter Oli", "Ganti Oli Mesin"] and v.has_anchor and v.segment == "Heavy Daily"
    cars = assets.select("asset_id", "customer_id", "plate", "model")
    master = denormalize_master(cars, cust)
    m = {r.asset_id: r for r in master.collect()}
    assert m["CAR0001"].owner_name == "Budi Siregar" and m["CAR0002"].owner_name is None
    assert master.columns[0] == "customer_id" and "km_per_month" in master.columns
