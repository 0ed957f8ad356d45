"""Category dimension of the crawled marketplaces.

A 44-row static table (platform, url_key, category_name, category_id); it is
broadcast into joins, its size being fixed by this file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Tiki categories as (name, urlKey, category id), in the reference's order.
TIKI_CATEGORIES: list[tuple[str, str, str]] = [
    ("Nhà Sách Tiki", "nha-sach-tiki", "8322"),
    ("Nhà Cửa - Đời sống", "nha-cua-doi-song", "1883"),
    ("Điện Thoại - Máy Tính Bảng", "dien-thoai-may-tinh-bang", "1789"),
    ("Đồ Chơi - Mẹ & Bé", "do-choi-me-be", "2549"),
    ("Thiết Bị Số - Phụ Kiện Số", "thiet-bi-so-phu-kien-so", "1815"),
    ("Điện Gia Dụng", "dien-gia-dung", "20824"),
    ("Làm Đẹp - Sức Khỏe", "lam-dep-suc-khoe", "1520"),
    ("Ô Tô - Xe Máy - Xe Đạp", "o-to-xe-may-xe-dap", "21346"),
    ("Thời Trang Nữ", "thoi-trang-nu", "931"),
    ("Bách Hóa Online", "bach-hoa-online", "4384"),
    ("Thể Thao - Dã Ngoại", "the-thao-da-ngoai", "1975"),
    ("Thời Trang Nam", "thoi-trang-nam", "915"),
    ("Laptop - Máy Vi Tính - Linh Kiện", "laptop-may-vi-tinh-linh-kien", "1846"),
    ("Giày Dép Nam", "giay-dep-nam", "1686"),
    ("Điện Tử - Điện Lạnh", "dien-tu-dien-lanh", "4221"),
    ("Giày Dép Nữ", "giay-dep-nu", "1703"),
    ("Máy Ảnh - Máy Quay Phim", "may-anh", "1801"),
    ("Phụ kiện thời trang", "phu-kien-thoi-trang", "27498"),
    ("Đồng hồ và Trang sức", "dong-ho-va-trang-suc", "8371"),
    ("Balo và Vali", "balo-va-vali", "6000"),
    ("Túi thời trang nữ", "tui-thoi-trang-nu", "976"),
    ("Túi thời trang nam", "tui-thoi-trang-nam", "27616"),
    ("Chăm sóc nhà cửa", "cham-soc-nha-cua", "15078"),
]

# Lazada categories as (name, path), in the reference's order.
LAZADA_CATEGORIES: list[tuple[str, str]] = [
    ("Điện thoại di động", "dien-thoai-di-dong"),
    ("Máy tính bảng", "may-tinh-bang"),
    ("Laptop", "laptop"),
    ("Pin sạc dự phòng", "pin-sac-du-phong"),
    ("Tai nghe không dây", "shop-wireless-earbuds"),
    ("Máy ảnh máy quay phim", "may-anh-may-quay-phim"),
    ("Tủ lạnh", "tu-lanh"),
    ("Máy giặt", "may-giat"),
    ("Máy lạnh", "may-lanh"),
    ("Áo phông & Áo ba lỗ", "shop-t-shirts-&-tanks"),
    ("Quần jeans", "shop-men-jeans"),
    ("Dưỡng da & Serum", "duong-da-va-serum"),
    ("Son thỏi", "son-thoi"),
    ("Bách hóa online", "bach-hoa-online"),
    ("Phụ kiện làm thơm phòng", "do-dung-lam-thom-phong"),
    ("Giường", "giuong"),
    ("Bóng đá", "bong-da"),
    ("Máy chạy bộ", "may-chay-bo"),
    ("Bikini", "bikini-2"),
    ("Búp bê cho bé", "bup-be-cho-be"),
    ("Xe máy", "xe-may"),
]

DIM_SCHEMA = T.StructType([
    T.StructField("platform", T.StringType(), False),
    T.StructField("url_key", T.StringType(), False),
    T.StructField("category_name", T.StringType(), False),
    T.StructField("category_id", T.StringType(), True),
])


def category_rows() -> list[tuple[str, str, str, str | None]]:
    rows = [("Tiki", key, name, cid) for name, key, cid in TIKI_CATEGORIES]
    rows += [("Lazada", path, name, None) for name, path in LAZADA_CATEGORIES]
    return rows


def category_dim(spark: SparkSession) -> DataFrame:
    """The category dimension as a DataFrame (44 rows).

    A VALUES list: Spark knows its size, and so broadcasts it by itself.
    """
    return spark.sql(f"SELECT * FROM {values_sql()}").to(DIM_SCHEMA)


def values_sql() -> str:
    """The dimension as a SQL VALUES list (for oracle queries)."""
    def q(s):
        return "NULL" if s is None else "'" + s.replace("'", "''") + "'"
    body = ", ".join(f"({q(p)}, {q(k)}, {q(n)}, {q(c)})" for p, k, n, c in category_rows())
    return f"(VALUES {body}) AS dim(platform, url_key, category_name, category_id)"
