from docrank.cli import main

main()
