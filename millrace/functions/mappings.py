"""Fixed values of the domain: labels, codes and keywords, in natural order."""

# Subjects by name.
SUBJECTS = {
    "toan": "T", "toán": "T", "t": "T",
    "ly": "L", "lý": "L", "l": "L", "vật lý": "L", "vat ly": "L",
    "hoa": "H", "hóa": "H", "h": "H", "hóa học": "H", "hoa hoc": "H",
    "sinh": "S", "sinh học": "S", "sinh hoc": "S",
    "van": "V", "văn": "V", "v": "V", "ngữ văn": "V", "ngu van": "V",
    "su": "Su", "sử": "Su", "s": "Su",
    "dia": "D", "địa": "D", "d": "D", "địa lý": "D", "dia ly": "D",
    "anh": "A", "a": "A", "tiếng anh": "A", "tieng anh": "A", "ngoại ngữ": "A",
    "gdcd": "G", "g": "G", "giáo dục công dân": "G", "giao duc cong dan": "G",
}

# Subject sets (sorted, joined by +) and their codes.
SUBJECT_SETS = {
    "H+L+T": "A00", "A+L+T": "A01", "H+S+T": "A08", "D+Su+V": "C00",
    "A+T+V": "D01", "D+H+T": "A02", "D+S+T": "B01", "A+S+T": "A10",
}

# Common names of combinations.
COMBO_ALIASES = {
    "toán lý hóa": "A00", "toán-lý-hóa": "A00", "toán lý anh": "A01", "toán-lý-anh": "A01",
    "văn sử địa": "C00", "văn-sử- địa": "C00", "toán văn anh": "D01", "toán-văn-anh": "D01",
    "toán hóa sinh": "A08", "toán sinh anh": "A10",
}

# Combination aliases that the page scan looks for within a text, in order.
SCAN_COMBO_ALIASES = {
    "toan ly hoa": "A00", "t l h": "A00", "toan-ly-hoa": "A00", "toan ly anh": "A01",
    "t l a": "A01", "toan-ly-anh": "A01", "toan van anh": "D01", "van su dia": "C00",
}

# The closed list of combination codes of the stored table.
COMBOS = (
    "A00 A01 A02 A03 A04 A05 A06 A07 A08 A09 A10 B00 B01 B02 B03 B04 B08 "
    "C00 C01 C02 C03 C04 C05 C06 C07 C08 C14 C15 C16 C17 C19 C20 "
    "D01 D02 D03 D04 D05 D06 D07 D08 D09 D10 D11 D12 D13 D14 D15 D78 D79 D80 D81 D82 D83 D84 D85 D86 X06 X26 KHAC"
).split()

METHODS = ("THPT", "hoc_ba", "DGNL", "SAT", "xet_tuyen_thang", "khac")

# Admission methods by label in lower case.
METHOD_LABELS = {
    "thpt": "THPT", "thi thpt": "THPT", "điểm thi thpt": "THPT", "diem thi thpt": "THPT", "thi tốt nghiệp": "THPT", "tot nghiep thpt": "THPT", "xét điểm thi thpt": "THPT", "xet diem thi thpt": "THPT",
    "hoc_ba": "hoc_ba", "học bạ": "hoc_ba", "hoc ba": "hoc_ba", "xét học bạ": "hoc_ba", "xet hoc ba": "hoc_ba", "điểm học bạ": "hoc_ba", "diem hoc ba": "hoc_ba", "học bạ thpt": "hoc_ba",
    "dgnl": "DGNL", "đánh giá năng lực": "DGNL", "danh gia nang luc": "DGNL", "đgnl": "DGNL", "bài thi đánh giá năng lực": "DGNL", "thi đánh giá năng lực": "DGNL", "đgnl đhqg tphcm": "DGNL", "đgnl đhqg hà nội": "DGNL",
    "sat": "SAT", "ielts": "SAT", "toefl": "SAT", "chứng chỉ quốc tế": "SAT", "chung chi quoc te": "SAT",
    "xet_tuyen_thang": "xet_tuyen_thang", "xét tuyển thẳng": "xet_tuyen_thang", "xet tuyen thang": "xet_tuyen_thang", "tuyển thẳng": "xet_tuyen_thang", "tuyen thang": "xet_tuyen_thang", "ưu tiên xét tuyển": "xet_tuyen_thang",
    "khac": "khac", "khác": "khac", "other": "khac", "phương thức khác": "khac",
}

# Keywords that tell the method within a text, in order.
METHOD_KEYWORDS = [
    (["hoc_ba", "hoc ba", "hoc-ba", "học bạ", "hocba"], "hoc_ba"),
    (["dgnl", "danh gia nang luc", "đánh giá"], "DGNL"),
    (["sat", "ielts", "toefl", "chứng chỉ", "chung chi"], "SAT"),
    (["thẳng", "thang", "ưu tiên", "uu tien"], "xet_tuyen_thang"),
    (["thpt", "tot nghiep", "tốt nghiệp"], "THPT"),
]

# The same for titles of score tables.
TITLE_KEYWORDS = [
    ("tuyen thang", "xet_tuyen_thang"), ("xet thang", "xet_tuyen_thang"), ("uu tien xet tuyen", "xet_tuyen_thang"),
    ("danh gia nang luc", "DGNL"), ("dgnl", "DGNL"), ("nang luc", "DGNL"), ("hoc ba", "hoc_ba"), ("xet hoc ba", "hoc_ba"),
    ("ielts", "SAT"), ("toefl", "SAT"), ("sat", "SAT"), ("thpt", "THPT"), ("thi thpt", "THPT"), ("diem thi", "THPT"),
]

# Labels of university types, regions and degree levels.
TYPES = {
    "công lập": "public", "cong lap": "public", "public": "public", "tư thục": "private", "tu thuc": "private", "private": "private",
    "dân lập": "private", "dan lap": "private", "liên kết nước ngoài": "foreign_affiliated", "foreign": "foreign_affiliated",
    "foreign_affiliated": "foreign_affiliated", "nước ngoài": "foreign_affiliated",
}
REGIONS = {
    "north": "north", "bắc": "north", "miền bắc": "north", "mien bac": "north", "hà nội": "north",
    "central": "central", "trung": "central", "miền trung": "central", "mien trung": "central", "đà nẵng": "central",
    "south": "south", "nam": "south", "miền nam": "south", "mien nam": "south", "hồ chí minh": "south", "tp.hcm": "south", "tphcm": "south",
}
DEGREES = {
    "bachelor": "bachelor", "cử nhân": "bachelor", "cu nhan": "bachelor", "engineer": "engineer", "kỹ sư": "engineer", "ky su": "engineer",
    "master": "master", "thạc sĩ": "master", "thac si": "master",
}

# Texts that stand for no score and no quota.
NO_SCORE = ["---", "--", "-", "n/a", "na", "không có", "khong co", "", "0", "tuyển thẳng", "tuyen thang", "xét tuyển thẳng"]
NO_QUOTA = ["---", "--", "-", "n/a", "na", "không có", ""]

# Words that mark a raw score as a placeholder.
PLACEHOLDERS = ["", "-", "--", "---", "n/a", "na"]
# The sources that have pages of their own; any other name is taken as the universities' own sites.
SOURCES = ["moet", "tuyensinh247"]
DEFAULT_YEARS = [2020, 2021, 2022, 2023, 2024, 2025]
# The quality metrics with the least percentage that passes; of duplicates, the most.
QUALITY_LIMITS = {
    "valid_rate": 95, "holland_coverage": 95, "university_score_coverage": 85, "description_rate": 90, "combo_coverage": 95, "duplicate_rate": 0, "salary_coverage": 80,
}
