"""Small statement files and reference fingerprints for tests."""

import hashlib
from xml.sax.saxutils import quoteattr


def element(tag, **attributes):
    parts = " ".join(f"{name}={quoteattr(value)}" for name, value in attributes.items())
    return f"<{tag} {parts}/>"


def statement(*elements):
    body = "\n".join(elements)
    return (
        '<?xml version="1.0" encoding="UTF-8"?>\n<FlexQueryResponse><FlexStatements>'
        f"<FlexStatement><Section>{body}</Section></FlexStatement></FlexStatements>"
        "</FlexQueryResponse>\n"
    )


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def sha(attributes):
    text = "|".join(f"{name}={attributes[name]}" for name in sorted(attributes))
    return hashlib.sha256(text.encode()).hexdigest()


def as_set(df, *columns):
    return {tuple(row) for row in df.select(*columns).collect()}


def as_list(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
