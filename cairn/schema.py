"""The engine's record and vector shapes, as DDL."""

PARAMETERS = "array<array<struct<name:string,type:string,required:boolean,default:string>>>"

RECORD = (
    f"name string, kind string, signatures array<string>, parameters {PARAMETERS}, doc string, writable boolean, "
    "members array<struct<name:string,value:string>>, enum_of string, type string, value string, explanation string, "
    "source string, license string, apis_used array<string>, unknown_refs array<string>, code string, "
    "heading_path array<string>, heading_level int, section_text string, corpus string"
)
VECTOR = "chunk_id string, record_id string, chunk_type string, text_hash string, embedding array<float>, document string"


def columns(ddl: str) -> list[str]:
    """The top-level column names of a DDL string."""
    names, depth, word = [], 0, ""
    for ch in ddl + ",":
        if ch == "," and depth == 0:
            names.append(word.split()[0])
            word = ""
            continue
        depth += (ch == "<") - (ch == ">")
        word += ch
    return names
