"""Create the schemas and tables that are missing."""

from jobs.common import parser
from tidemark.session import build_session
from tidemark.tables.bootstrap import bootstrap


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("--property", action="append", default=[], metavar="KEY=VALUE", help="of every table; may be repeated")
    args = p.parse_args(argv)
    if any("=" not in x for x in args.property):
        raise SystemExit("--property takes KEY=VALUE")
    properties = dict(x.split("=", 1) for x in args.property)
    bootstrap(build_session("bootstrap"), args.catalog, args.format, args.root, properties)


if __name__ == "__main__":
    main()
