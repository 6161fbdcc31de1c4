"""ZIP64 directories: overflowing end records and central fields, many members, comments that look like an end."""

import io
import struct
import zipfile

import pytest
from gridpulse.llm import zip_warc

WIDE = 0xFFFFFFFF
RECORDS = [zip_warc.gzip.compress(x) for x in (b"one", b"two" * 1000, b"")]


def overflowing(data: bytes, comment: bytes = b"", fields: tuple[str, ...] = ("plain", "packed", "header")) -> bytes:
    """The same archive with a directory all of whose numbers stand in ZIP64 forms."""
    members = zip_warc.directory(io.BytesIO(data), len(data))
    start = struct.unpack("<I", data[data.rfind(zip_warc.END) + 16 :][:4])[0]
    central = b""
    for m in members:
        values = {"plain": m.size, "packed": m.size, "header": m.header}
        wide = b"".join(struct.pack("<Q", values[f]) for f in ("plain", "packed", "header") if f in fields)
        extra = struct.pack("<HH", 0x7075, 3) + b"abc" + struct.pack("<HH", 1, len(wide)) + wide
        shown = {k: WIDE if k in fields else v for k, v in values.items()}
        name = m.name.encode()
        central += zip_warc.CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, 0, 0, 0, 0, shown["packed"], shown["plain"],
                                                  len(name), len(extra), 2, 0, 0, 0, shown["header"]) + name + extra + b"hi"
    record = zip_warc.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, len(members), len(members), len(central), start)
    locator = zip_warc.LOCATOR64 + struct.pack("<IQI", 0, start + len(central), 1)
    end = zip_warc.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, WIDE, WIDE, len(comment)) + comment
    return data[:start] + central + record + locator + end


@pytest.mark.parametrize("fields", [("plain", "packed", "header"), ("header",), ("plain", "packed"), ("packed",)])
@pytest.mark.parametrize("comment", [b"", b"a comment", zip_warc.END + b"\0" * 30, zip_warc.END + b"\0" * 18])
def test_every_number_may_overflow(fields, comment):
    data = zip_warc.pack_archive(RECORDS)
    wide = overflowing(data, comment, fields)
    assert zip_warc.directory(io.BytesIO(wide), len(wide)) == zip_warc.directory(io.BytesIO(data), len(data))
    assert list(zip_warc.read_records(io.BytesIO(wide), len(wide))) == [b"one", b"two" * 1000, b""]


def test_more_members_than_the_plain_end_record_can_count():
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w") as archive:
        for i in range(65_600):
            archive.writestr(f"m{i}", "")
    data = file.getvalue()
    members = zip_warc.directory(io.BytesIO(data), len(data))
    assert len(members) == 65_600 and members[-1].name == "m65599"


def test_broken_directories_say_so():
    data = zip_warc.pack_archive(RECORDS)
    wide = bytearray(overflowing(data))
    wide[wide.rfind(zip_warc.END64)] = 0
    with pytest.raises(ValueError, match="ZIP64"):
        zip_warc.directory(io.BytesIO(bytes(wide)), len(wide))
    broken = bytearray(data)
    broken[broken.rfind(zip_warc.CENTRAL)] = 0
    with pytest.raises(ValueError, match="central"):
        zip_warc.directory(io.BytesIO(bytes(broken)), len(broken))
