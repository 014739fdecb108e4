"""Small export folders written by hand."""

from __future__ import annotations

PREAMBLE = [
    "Database Name\tlibrary 7", "Database Link\thttp://host.example", "Evaluation Signature\t0f1e2d",
    "Plate Name\t{plate}", "Measurement\tMeasurement 3", "Evaluation\tEvaluation2",
    "Population\tPopulation - Second", "", "[Data]",
]
OBJECT_HEADER = [
    "Row", "Column", "Plane", "Timepoint", "Field", "Object No", "X", "Y", "Bounding Box",
    "Position X [µm]", "Position Y [µm]", "", "", "",
]
LONG = "O4 Final - " + "Very Long Intensity Name " * 3 + "Mean"
INDEX_HEADER = [
    "Row", "Column", "Plane", "Timepoint", "Sequence", "Field", "Channel ID", "Channel Name",
    "Channel Type", "Image Size X", "Image Size Y", "Position X [m]", "Position Y [m]", "URL",
]
CHANNELS = ["HOECHST 33342", "Alexa 488narrow", "Alexa 647"]
LINKS = {"Hoechst": "HOECHST 33342", "O4Final": "Alexa 488narrow"}


def write(path, lines, encoding="cp1252", bom=False, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = end.join(lines) + end
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode(encoding))


def object_line(row, column, field, number, values, x=10, y=20):
    cells = [row, column, 1, 1, field, number, x, y, "[1,2,3,4]", 0.5, -0.5, "", "", "", *values]
    return "\t".join(str(c) for c in cells)


def index_lines(images, channels=CHANNELS):
    lines = ["\t".join(INDEX_HEADER)]
    for row, column, field in images:
        for number, channel in enumerate(channels, start=1):
            cells = [row, column, 1, 1, 1, field, number, channel, "Fluorescence", 1080, 1080, 0.1, 0.2, "http://x"]
            lines.append("\t".join(str(c) for c in cells))
    return lines


def write_plate(root, plate, name, images, hoechst, o4, bom=False):
    """A plate with a header-first and a preamble object table and results."""
    base = root / plate
    write(base / "Index.txt", index_lines(images), bom=bom)
    header = [*OBJECT_HEADER, "Hoechst - Area [µm²]", "Hoechst - Object No in Ch"]
    write(base / "Evaluation 6" / "Objects_Population - Hoechst.txt", ["\t".join(header), *hoechst], bom=bom)
    preamble = [line.format(plate=name) for line in PREAMBLE]
    header = "\t".join([*OBJECT_HEADER, "O4 Final - Area [µm²]", LONG])
    write(base / "Evaluation 6" / "Objects_Population - O4 Final.txt", [*preamble, header, *o4], end="\r\n")
    results = ["\t".join(["Row", "Column", "Compound", "Number of Objects"]), "1.0\t1.0\tDMSO\t3", "1\t2\tNA\t4"]
    write(base / "Evaluation 6" / "PlateResults.txt", [*preamble, *results])


def write_images(root, plate, images, channels=(1, 2, 3)):
    for row, column, field in images:
        for channel in channels:
            write(root / plate / "Images" / f"r{row:02}c{column:02}f{field:02}p01-ch{channel}sk1fk1fl1.tiff", ["x"])


def two_plates(root, images_root):
    """FIRST: an object without image, an image without objects, NaN, text and
    empty cells. SECOND: another order of images, a byte order mark."""
    first = [(1, 2, 1), (1, 1, 1), (1, 1, 2)]
    write_plate(
        root, "FIRST__2024 a+b-Measurement 1", "Rowan Row plate", first,
        [object_line(1, 1, 1, 1, [1.0, 1]), object_line(1, 1, 1, 2, [3.0, 2]),
         object_line(1, 1, 1, 3, ["NaN", 3]), object_line(1, 2, 1, 1, ["junk", 1]),
         object_line(2, 3, 1, 1, [7.5, 1])],
        [object_line(1, 1, 2, 1, [10.5, 100.0]), object_line("1.0", "1", 2, 2, ["", 300.0])],
    )
    write_images(images_root, "FIRST__2024 a+b-Measurement 1", first[1:])
    second = [(1, 1, 2), (1, 1, 1)]
    write_plate(
        root, "SECOND-Measurement 1", "Second", second,
        [object_line(1, 1, 1, 1, [100.0, 1])], [object_line(1, 1, 1, 1, [200.0, 1.0])], bom=True,
    )
    write_images(images_root, "SECOND-Measurement 1", second)
