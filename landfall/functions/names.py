"""Column-name helpers."""


def quoted(name):
    """A name usable in ``F.col`` even with spaces, hyphens or dots."""
    return "`" + name.replace("`", "``") + "`"


def fresh(name, *frames):
    """``name``, lengthened until no column of the frames has it (in any case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
