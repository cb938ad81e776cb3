"""Small bronze folder with the edge rows of FIXTURES.md."""

from __future__ import annotations

import unicodedata

DAY = 86_400_000
JAN_31 = 1_706_659_200_000  # 2024-01-31 UTC


def listing(identifier, **fields):
    base = {
        "id": identifier, "project_id": "p1", "sector_id": "s1", "sector_name": "S one", "project_name": "grand park", "province": "HCM",
        "district": "Q9", "ward": "W1", "min_selling_price": 1000, "max_selling_price": 2000, "min_unit_price": 10,
        "max_unit_price": 20, "min_area": 50, "max_area": 60, "views": ["Hồ bơi"], "last_modified_date": JAN_31,
        "geolocation": {"lat_cdnt": 10.12345, "long_cdnt": 106.5}, "view_count": {"count": 3},
        "property_furnitures": {"furniture_status": "Cơ bản"}, "number_of_bathrooms": [2, 1], "number_of_bedrooms": 2,
        "directions": ["Đông Nam"], "property_type": ["Căn hộ"], "positions": ["Góc"], "floor_number": "Tầng 12A",
        "urgent_sale": True, "sell_for_cut_losses": None,
    }
    return {**base, **fields}


FIRST_RUN = [
    listing(1, project_name="old name", last_modified_date=JAN_31),
    listing("2", min_selling_price=None),
    listing("3", min_area=None),
    listing("4", views=None),
    listing("5", views=[], sector_id="lonely"),
    listing("6", views=["K"]),
    listing("7", views=["k", "k"]),
]
SECOND_RUN = [
    listing("1", project_name="  grand-park s2a ", last_modified_date=JAN_31 + 2 * DAY, views=["Ngoại khu (Hồ bơi)"]),
    listing("8", views=[unicodedata.normalize("NFD", "Ngoại khu (Hồ bơi)")], min_selling_price=2.5, max_selling_price=3.5),
    listing("9", views=["nghĩa trang", "công viên"]),
    listing("10", views=["đất trống", "đất trống"], inventory_code="a High-quanlity b"),
    listing("11", views=["nôi khu"], sector_id=None, project_id=None),
    listing("12", views=["nộii khu"], sector_id=None, project_id="gone", min_area=50, max_area=50),
    listing("13", views=["x y"], min_area=80, max_area=80, geolocation=None, urgent_sale=None, unread={"a": 1}),
]

PROJECTS = [
    {
        "id": "p1", "name": "Grand Park", "district": "Q9", "province": "HCM", "developer_name": "Dev",
        "number_ele": [4], "number_basement": [1, 3], "handover_date_from": "2026-03-01",
        "construction_start_date_from": "2026", "demand_code": ["SECONDARY", "PRIMARY"], "monthly_service_fee": [7],
        "min_unit_price": 2.5, "max_unit_price": 3.5, "max_prop_per_floor": 8, "rank": "CAO CẤP", "local_bus": "Yes",
        "cstn_dens": 0.5, "center_rd_dist": 4, "lat_cdnt": 10.1, "long_cdnt": 106.1,
        "quality_indexes": [
            {"id": 1, "name": "I1", "code": "c1", "parent_type": "PROJECT",
             "attributes": [{"id": 11, "name": "Xe buýt"}, {"id": 12, "name": "Hồ"}]},
            {"id": 2, "name": "Công viên", "code": "c2", "parent_type": "PROJECT", "attributes": []},
            {"id": 3, "name": "Vincom", "code": "c3", "parent_type": "PROJECT", "attributes": None},
            {"id": 4, "name": "other", "code": "c4", "parent_type": "SECTOR", "attributes": [{"id": 41, "name": "z"}]},
            {"id": 5, "name": "n1", "code": None, "parent_type": "PROJECT", "attributes": []},
            {"id": 6, "name": "n2", "code": None, "parent_type": "PROJECT", "attributes": []},
        ],
    },
    {"id": "p2", "name": "Empty", "district": "Q2", "handover_date_from": "", "number_ele": [1, 0]},
    {"id": 77, "name": "Numeric id", "district": None, "developer_name": "Dev", "handover_date_from": "2024-1-5"},
]
SUBDIVISIONS = [
    {"sector_id": "s1", "sector_name": "S one", "project_id": "p1", "type": "t", "number_ele": [2, 4],
     "min_prop_per_floor": 3, "max_prop_per_floor": 6, "handover_date_to": "2025-12-31T10:00:00Z"},
    {"sector_id": "s2", "sector_name": "S two", "project_id": "missing"},
]
PRICES = [
    {"project_id": "p1", "price_history": {"value": [
        {"unit": 3, "year": 2024, "price_average": 10.0, "percent": 1.0},
        {"unit": 3, "year": 2024, "price_average": 30.0, "percent": None},
        {"unit": 11, "year": 2023, "price_average": 5.0, "percent": 2.0},
        {"unit": 1, "year": None, "price_average": 9.0, "percent": 0.0},
    ]}, "price_chart": {"any": [1, 2]}},
    {"project_id": "s1", "price_history": {"value": [{"unit": 3, "year": 2024, "price_average": 99.0, "percent": 9.0}]}},
    {"project_id": "gone", "price_history": {"value": [{"unit": 3, "year": 2024, "price_average": 1.0, "percent": 0.0}]}},
    {"project_id": "p2", "price_history": None},
    {"project_id": "77", "price_history": {}},
]


def write_bronze(directory, write_jsonl) -> str:
    directory.mkdir(parents=True, exist_ok=True)
    write_jsonl(directory / "properties_20240131_060000.jsonl", FIRST_RUN)
    write_jsonl(directory / "properties_20240202_060000.jsonl", SECOND_RUN)
    write_jsonl(directory / "projects_20240131_060000.jsonl", PROJECTS)
    write_jsonl(directory / "projects_20240202_060000.jsonl", [{"id": "p2", "name": "Empty, newer", "district": "Q2"}])
    write_jsonl(directory / "subdivisions_20240131_060000.jsonl", SUBDIVISIONS)
    write_jsonl(directory / "project_prices_20240131_060000.jsonl", PRICES)
    return str(directory)
